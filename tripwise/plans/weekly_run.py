"""The whole weekly run over all dated tables, restartable step by step.

For each table: slice the week from its source into the raw zone, cleanse it
(keep-list, rows with nulls, binary text), load it typed; for lodging and
visits also stream the changed weeks into the processed zone; at the end
rebuild and publish the marts.  A ledger keeps one record for each finished
step of a week: what went in, where the output is.  A run that starts again
skips the steps whose record names the same inputs and does the others, which
replace their own output only.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cleanse import cleanse
from ..schemas import CUTOFF_COLUMN, PROCESSED_SCHEMAS, RAW_SCHEMAS
from ..sources.load import align_schema, read_typed_weeks, read_weeks, weekly_append, write_typed_weeks
from ..sources.sinks import WEEK, delete_path, list_weeks, write_weekly
from ..streaming.incremental import append_week_changes, read_loaded
from .pipeline import land_week
from .processed import codeb_capital
from .publish import get_file, publish, put_file
from .weekly import mart_frames, together

#: Keep-list of each dated table.
KEYS = {"activity_consume": "tn_activity_consume", "lodge_consume": "tn_lodge_consume", "move": "tn_move_his",
        "mvmn_consume": "tn_mvmn_consume", "travel": "tn_travel_travel", "visit_area_info": "tn_visit_area"}


class Ledger:
    """Finished steps of one week, one small file each."""

    def __init__(self, spark: SparkSession, root: str, week: str):
        self.spark, self.folder, self.done = spark, f"{root}/ledger/{week}", []

    def step(self, name: str, inputs: dict, work: Callable[[], str]) -> str:
        """Output of step ``name``: remembered if it ended with the same
        inputs, else made now."""
        path = f"{self.folder}/{name}.json"
        text = get_file(self.spark, path)
        if text is not None:
            record = json.loads(text)
            if record["inputs"] == inputs:
                return record["output"]
            delete_path(self.spark, path)  # the step is open again
        output = work()
        put_file(self.spark, path, json.dumps({"step": name, "inputs": inputs, "output": output}))
        self.done.append(name)
        return output


def cleanse_week(spark: SparkSession, raw_root: str, clean_root: str, table: str, week: str) -> str:
    """One raw week through the cleansing step; it replaces its week of the
    clean zone."""
    raw_dir, target = f"{raw_root}/{table}", f"{clean_root}/{table}"
    if week not in list_weeks(spark, raw_dir):
        delete_path(spark, f"{target}/{WEEK}={week}")
        return target
    rows = cleanse(read_weeks(spark, raw_dir, [week]).drop(WEEK), KEYS[table])
    return write_weekly(rows.withColumn(WEEK, F.lit(week)), clean_root, table, replace_week=week)


def analysis_inputs(spark: SparkSession, root: str, reference: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The marts' inputs as the run's typed and processed zones hold them."""
    typed = {t: read_typed_weeks(spark, t, f"{root}/typed/{t}") for t in ("travel", "mvmn_consume", "activity_consume", "lodge_consume")}
    return typed | {
        "traveller_master": reference["traveller_master"], "codes": codeb_capital(reference["meta_codeb"]),
        "processed_visit": read_loaded(spark, f"{root}/processed/visit_area_info", PROCESSED_SCHEMAS["visit_area_info"]),
        "processed_lodge": read_loaded(spark, f"{root}/processed/lodge_consume", PROCESSED_SCHEMAS["lodge_consume"])}


def run_week(spark: SparkSession, sources: dict[str, DataFrame], reference: dict[str, DataFrame], root: str,
             week: str, week_end: str, version: str = "1", since_week: str | None = None, before_step: Callable[[str], None] = lambda name: None) -> list[str]:
    """Do the week's steps that are not done; returns their names.

    ``version`` names the state of the sources: a later delivery of the same
    week comes with another one and is done again from the slice on.
    ``before_step`` is called ahead of every step that is to be done."""
    ledger = Ledger(spark, root, week)
    raw, clean = f"{root}/raw", f"{root}/clean"

    def step(name, inputs, work):
        def announced():
            before_step(name)
            return work()
        return ledger.step(name, inputs | {"version": version}, announced)

    outputs = {}
    for table in CUTOFF_COLUMN:
        source, typed = sources[table], f"{root}/typed/{table}"
        landed = step(f"slice-{table}", {"week": week, "end": week_end}, lambda: land_week(source, table, week, week_end, raw))
        cleaned = step(f"cleanse-{table}", {"raw": landed}, lambda: cleanse_week(spark, raw, clean, table, week))

        def load():
            weekly_append(spark, clean, table, week, typed)
            return typed

        outputs[table] = step(f"load-{table}", {"clean": cleaned}, load)
        if table in PROCESSED_SCHEMAS:
            def stream():
                target = f"{root}/processed/{table}"
                append_week_changes(spark, cleaned, table, target, f"{root}/checkpoints/{table}", since_week=since_week)
                return target

            outputs[f"processed {table}"] = step(f"stream-{table}", {"clean": cleaned}, stream)

    def refresh():
        frames = mart_frames(spark, analysis_inputs(spark, root, reference), f"{root}/tmp/{week}-{version}")
        return str(publish(spark, frames, f"{root}/analysis"))

    step("marts", outputs, refresh)
    return ledger.done


def typed_zone(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {t: read_typed_weeks(spark, t, f"{root}/typed/{t}") for t in CUTOFF_COLUMN}


def seed_zone(sources: dict[str, DataFrame], root: str, batch_of: Callable[[str], Column], before: str) -> None:
    """The initial zones: every table's rows dated before ``before`` landed,
    cleansed and typed at once, in load batches whose labels precede it (the
    processed zone streams them later).  The tables do not depend on each
    other and are seeded side by side."""
    def seed(table, column):
        rows = sources[table].filter(F.col(column) < F.to_date(F.lit(before))).withColumn(WEEK, batch_of(column))
        write_weekly(rows, f"{root}/raw", table)
        kept = cleanse(rows.drop(WEEK), KEYS[table]).withColumn(WEEK, batch_of(column))
        write_weekly(kept, f"{root}/clean", table)
        typed = align_schema(kept, RAW_SCHEMAS[table], keep_extra=True).select(*[f.name for f in RAW_SCHEMAS[table].fields], WEEK)
        write_typed_weeks(typed, f"{root}/typed/{table}")

    together([lambda table=table, column=column: seed(table, column) for table, column in CUTOFF_COLUMN.items()])
