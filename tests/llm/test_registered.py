"""Which queries are compared with SQL and which with brute force."""

import __spark_entry__ as entry
from tripwise.llm import queries

#: Beyond SQL: models, tokenizers, sketches and searches.  Their own tests hold
#: them against brute force, round trips or held-out accuracy.
WITHOUT_SQL = {"op1_token_files", "op2_packing", "op3_sharding", "op4_prefix_counts", "op6_nearest_neighbours", "op7_near_duplicates",
               "op8_toxic_spans", "op11_turn_repair", "op13_suffix_dedup"}


def test_every_query_has_sql_or_is_named():
    assert set(queries.QUERIES) - set(queries.ORACLE) == WITHOUT_SQL
    assert set(entry.queries()) - set(entry.oracle_sql()) == WITHOUT_SQL | {"pipeline"}
