"""ZIP containers as random-access storage: a writer of stored members and a
reader that parses the central directory (ZIP64 too) and reads byte ranges of
members in place."""

from __future__ import annotations

import struct
import zlib

LOCAL, CENTRAL, END = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06"
END64, LOCATOR64 = b"PK\x06\x06", b"PK\x06\x07"
FULL32, FULL16 = 0xFFFFFFFF, 0xFFFF


def zip_of(members: list[tuple[str, bytes]], zip64: bool = False):
    """Byte chunks of a ZIP file with the members stored, not deflated.
    ``zip64`` forces the 64-bit records that large files need."""
    at, directory = 0, []
    for name, data in members:
        raw, crc, size = name.encode(), zlib.crc32(data), len(data)
        big = zip64 or size >= FULL32
        extra = struct.pack("<HHQQ", 1, 16, size, size) if big else b""
        shown = FULL32 if big else size
        yield struct.pack("<4sHHHHHIIIHH", LOCAL, 45 if big else 20, 0x800, 0, 0, 33, crc, shown, shown, len(raw), len(extra)) + raw + extra
        yield data
        far = zip64 or at >= FULL32
        fields = (struct.pack("<QQ", size, size) if big else b"") + (struct.pack("<Q", at) if far else b"")
        extra64 = struct.pack("<HH", 1, len(fields)) + fields if fields else b""
        directory.append(struct.pack("<4sHHHHHHIIIHHHHHII", CENTRAL, 45, 45 if big or far else 20, 0x800, 0, 0, 33, crc, shown, shown,
                                     len(raw), len(extra64), 0, 0, 0, 0, FULL32 if far else at) + raw + extra64)
        at += 30 + len(raw) + len(extra) + size
    listing = b"".join(directory)
    yield listing
    n, size = len(members), len(listing)
    if zip64 or at + size >= FULL32 or n >= FULL16:
        yield struct.pack("<4sQHHIIQQQQ", END64, 44, 45, 45, 0, 0, n, n, size, at)
        yield struct.pack("<4sIQI", LOCATOR64, 0, at + size, 1)
        yield struct.pack("<4sHHHHIIH", END, 0, 0, FULL16, FULL16, FULL32, FULL32, 0)
    else:
        yield struct.pack("<4sHHHHIIH", END, 0, 0, n, n, size, at, 0)


class ZipReader:
    """Members of a seekable ZIP file; nothing is extracted."""

    def __init__(self, file, size: int):
        self.file = file
        self.members: dict[str, dict] = {}
        tail_at = max(0, size - (1 << 16) - 22)
        tail = self.read(tail_at, size - tail_at)
        end = tail.rfind(END)
        while end >= 0 and (end + 22 > len(tail) or end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail)):
            end = tail.rfind(END, 0, end)  # the signature was part of a comment
        if end < 0:
            raise ValueError("no end of central directory: not a ZIP file, or cut off")
        count, length, at = struct.unpack_from("<HII", tail, end + 10)
        directory_end = tail_at + end
        if FULL16 == count or FULL32 in (length, at):
            magic, _, record, _ = struct.unpack("<4sIQI", self.read(tail_at + end - 20, 20))
            if magic == LOCATOR64:
                # Data put before the archive shifts all its offsets.
                head = self.read(record, 56)
                if head[:4] != END64:
                    record = tail_at + end - 20 - 56
                    head = self.read(record, 56)
                count, length, at = struct.unpack_from("<QQQ", head, 32)
                directory_end = record
        self.shift = directory_end - length - at
        self._parse(self.read(at + self.shift, length), count)

    def read(self, at: int, length: int) -> bytes:
        self.file.seek(at)
        data = self.file.read(length)
        if len(data) != length:
            raise ValueError("the ZIP file is cut off")
        return data

    def _parse(self, listing: bytes, count: int) -> None:
        at = 0
        for _ in range(count):
            if listing[at:at + 4] != CENTRAL:
                raise ValueError("damaged central directory")
            flags, method = struct.unpack_from("<HH", listing, at + 8)
            crc, packed, size, name_n, extra_n, note_n = struct.unpack_from("<IIIHHH", listing, at + 16)
            offset = struct.unpack_from("<I", listing, at + 42)[0]
            name = listing[at + 46:at + 46 + name_n].decode("utf-8" if flags & 0x800 else "cp437")
            extra = listing[at + 46 + name_n:at + 46 + name_n + extra_n]
            while len(extra) >= 4:
                kind, n = struct.unpack_from("<HH", extra)
                if kind == 1:  # 64-bit values of the fields that overflow, in this order
                    values = iter(struct.unpack_from(f"<{n // 8}Q", extra, 4))
                    size, packed, offset = (next(values) if v == FULL32 else v for v in (size, packed, offset))
                extra = extra[4 + n:]
            self.members[name] = {"method": method, "crc": crc, "packed": packed, "size": size, "offset": offset + self.shift}
            at += 46 + name_n + extra_n + note_n

    def start(self, name: str) -> int:
        """Where the member's bytes begin in the file."""
        at = self.members[name]["offset"]
        head = self.read(at, 30)
        if head[:4] != LOCAL:
            raise ValueError(f"no local header of {name}")
        return at + 30 + sum(struct.unpack_from("<HH", head, 26))

    def range(self, name: str, offset: int, length: int) -> bytes:
        """Bytes of a stored member, read in place."""
        member = self.members[name]
        if member["method"] != 0:
            raise ValueError(f"{name} is compressed; ranges need stored members")
        if offset < 0 or offset + length > member["size"]:
            raise ValueError(f"range beyond the end of {name}")
        return self.read(self.start(name) + offset, length)

    def whole(self, name: str) -> bytes:
        """A small member (an index or a listing), inflated if need be."""
        member = self.members[name]
        data = self.read(self.start(name), member["packed"])
        if member["method"] == 8:
            data = zlib.decompress(data, -15)
        elif member["method"]:
            raise ValueError(f"{name}: unknown compression {member['method']}")
        if zlib.crc32(data) != member["crc"]:
            raise ValueError(f"{name}: wrong checksum")
        return data
