"""Find the members of a ZIP package by its directories, ZIP64 included, and read stored ones by range."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from typing import NamedTuple

# Fixed values of the format: signatures, and field values that send the reader to the ZIP64 fields.
END = b"PK\x05\x06"
END64 = b"PK\x06\x06"
LOCATOR64 = b"PK\x06\x07"
ENTRY = b"PK\x01\x02"
LOCAL = b"PK\x03\x04"
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF
END_FIELDS = struct.Struct("<4s4H2LH")
LOCATOR_FIELDS = struct.Struct("<4sLQL")
END64_FIELDS = struct.Struct("<4sQ2H2L4Q")
ENTRY_FIELDS = struct.Struct("<4s6H3L5H2L")
LOCAL_FIELDS = struct.Struct("<4s5H3L2H")


class Member(NamedTuple):
    name: str
    method: int
    size: int
    stored: int
    header: int


def at(stream, offset: int, length: int) -> bytes:
    stream.seek(offset)
    data = stream.read(length)
    if len(data) != length:
        raise ValueError("the package ends too early")
    return data


def directory_place(stream) -> tuple[int, int, int]:
    """(entries, length, offset) of the central directory; a comment may follow the end record."""
    size = stream.size()
    n = min(size, END_FIELDS.size + FULL16)
    tail = at(stream, size - n, n)
    k = tail.rfind(END)
    while k >= 0 and (len(tail) - k < END_FIELDS.size or END_FIELDS.unpack_from(tail, k)[7] != len(tail) - k - END_FIELDS.size):
        k = tail.rfind(END, 0, k)
    if k < 0:
        raise ValueError("no end of central directory: not a ZIP package")
    _, disk, first_disk, _, entries, length, offset, _ = END_FIELDS.unpack_from(tail, k)
    if FULL16 in (entries, disk, first_disk) or FULL32 in (length, offset):
        place = size - n + k - LOCATOR_FIELDS.size
        signature, _, end64, _ = LOCATOR_FIELDS.unpack(at(stream, place, LOCATOR_FIELDS.size))
        if signature != LOCATOR64:
            raise ValueError("no ZIP64 locator where one is needed")
        fields = END64_FIELDS.unpack(at(stream, end64, END64_FIELDS.size))
        if fields[0] != END64:
            raise ValueError("no ZIP64 end record where the locator points")
        disk, first_disk, _, entries, length, offset = fields[4:]
    if disk or first_disk:
        raise ValueError("packages of several disks aren't read")
    return entries, length, offset


def members(stream) -> Iterator[Member]:
    """All members, from the central directory alone."""
    entries, length, offset = directory_place(stream)
    data, k = at(stream, offset, length), 0
    for _ in range(entries):
        f = ENTRY_FIELDS.unpack_from(data, k)
        if f[0] != ENTRY:
            raise ValueError("broken central directory")
        flags, method, stored, size, n_name, n_extra, n_comment, header = f[3], f[4], f[8], f[9], f[10], f[11], f[12], f[16]
        k += ENTRY_FIELDS.size
        name = data[k : k + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        extra = data[k + n_name : k + n_name + n_extra]
        k += n_name + n_extra + n_comment
        # The ZIP64 field holds, in this order, only those values that don't fit their own fields.
        wide = iter(zip64_values(extra))
        size = next(wide) if size == FULL32 else size
        stored = next(wide) if stored == FULL32 else stored
        header = next(wide) if header == FULL32 else header
        yield Member(name, method, size, stored, header)


def zip64_values(extra: bytes) -> list[int]:
    k = 0
    while k + 4 <= len(extra):
        kind, n = struct.unpack_from("<HH", extra, k)
        if kind == 1:
            return list(struct.unpack_from(f"<{n // 8}Q", extra, k + 4))
        k += 4 + n
    return []


def data_offset(stream, member: Member) -> int:
    """Where the bytes of a stored member begin."""
    if member.method or member.size != member.stored:
        raise ValueError(f"{member.name} is packed; only stored members can be read by range")
    f = LOCAL_FIELDS.unpack(at(stream, member.header, LOCAL_FIELDS.size))
    if f[0] != LOCAL:
        raise ValueError("broken local header")
    return member.header + LOCAL_FIELDS.size + f[9] + f[10]
