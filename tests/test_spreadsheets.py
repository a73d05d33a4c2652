"""Legacy spreadsheets, written record by record."""

import struct

import pytest

from millrace.sources import io
from millrace.sources import spreadsheets as X


def record(kind, data):
    return struct.pack("<HH", kind, len(data)) + data


def compound(stream):
    """A compound file that holds the stream: in sectors, or in the small ones if it is short."""
    small = len(stream) < 4096
    entry = lambda name, kind, start, size: name.encode("utf-16-le").ljust(64, b"\0") + struct.pack("<HBB", 2 * len(name) + 2, kind, 1) + struct.pack("<3I", *[0xFFFFFFFF] * 3) + b"\0" * 36 + struct.pack("<IQ", start, size)
    pad = lambda b, n: b + b"\0" * (-len(b) % n)
    body = pad(stream, 64 if small else 512)
    n = len(pad(body, 512)) // 512
    # Sectors: 0 the FAT, 1 the directory, 2 the mini FAT, then the stream.
    fat = [0xFFFFFFFD, 0xFFFFFFFE, 0xFFFFFFFE, *range(4, 3 + n), 0xFFFFFFFE]
    mini = [*range(1, len(body) // 64), 0xFFFFFFFE] if small else []
    dirs = entry("Root Entry", 5, 3 if small else 0xFFFFFFFE, len(body) if small else 0) + entry("Workbook", 2, 0 if small else 3, len(stream)) + b"\0" * 256
    head = X.MAGIC + b"\0" * 16 + struct.pack("<5H", 0x3E, 3, 0xFFFE, 9, 6) + b"\0" * 10 + struct.pack("<9I", 1, 1, 0, 4096, 2, 1, 0xFFFFFFFE, 0, 0)
    head = head.ljust(512, b"\xff")
    table = struct.pack(f"<{len(fat)}I", *fat).ljust(512, b"\xff")
    minis = struct.pack(f"<{len(mini)}I", *mini).ljust(512, b"\xff")
    return head + table + dirs + minis + pad(body, 512)


def book(extra=b""):
    text = lambda s, wide=False: struct.pack("<HB", len(s), wide) + s.encode("utf-16-le" if wide else "latin-1")
    first = text("plain") + text("breit ü €", True) + struct.pack("<HBH", 3, 8, 1) + b"ric" + b"\0" * 4
    cut = struct.pack("<HB", 6, 0) + b"abc"  # goes on in the next record, there as wide characters
    strings = record(X.STRINGS, struct.pack("<II", 4, 4) + first + cut) + record(X.CONTINUE, b"\x01" + "def".encode("utf-16-le"))
    head = record(X.BOF, b"\0" * 16) + strings
    sheet = lambda at: record(X.SHEET, struct.pack("<IHBB", at, 0, 3, 0) + b"One")
    begin = len(head) + len(sheet(0)) + 4
    cell = lambda kind, row, col, data: record(kind, struct.pack("<HHH", row, col, 0) + data)
    body = record(X.BOF, b"\0" * 16)
    body += b"".join(cell(X.FROM_STRINGS, 0, i, struct.pack("<I", i)) for i in range(4))
    body += cell(X.NUMBER, 1, 0, struct.pack("<d", 2.5)) + cell(X.RK, 1, 1, struct.pack("<I", (7 << 2) | 2)) + cell(X.RK, 1, 2, struct.pack("<I", ((-5 << 2) & 0xFFFFFFFF) | 3))
    body += record(X.MANY_RK, struct.pack("<HH", 2, 1) + struct.pack("<HI", 0, (1 << 2) | 2) + struct.pack("<HI", 0, (2 << 2) | 2) + struct.pack("<H", 2))
    body += cell(X.LABEL, 3, 0, text("label")) + cell(X.BOOL, 3, 1, b"\x01\0") + cell(X.FORMULA, 3, 2, struct.pack("<d", 9.0) + b"\0" * 8) + cell(X.FORMULA, 3, 3, b"\0\0\0\0\0\0\xff\xff" + b"\0" * 8) + record(X.RESULT, text("told"))
    return head + sheet(begin) + record(X.EOF, b"") + body + extra + record(X.EOF, b"")


WANT = {0: {0: "plain", 1: "breit ü €", 2: "ric", 3: "abcdef"}, 1: {0: "2.5", 1: "7", 2: "-0.05"}, 2: {1: "1", 2: "2"}, 3: {0: "label", 1: "TRUE", 2: "9", 3: "told"}}


@pytest.mark.parametrize("extra", [b"", record(0x99, b"\0" * 6000)])
def test_cells(extra):
    got = {}
    for sheet, row, col, value in X.cells(compound(book(extra))):
        assert sheet == "One"
        got.setdefault(row, {})[col] = value
    assert got == WANT


def test_rows_of_files(spark, tmp_path):
    (tmp_path / "a.xls").write_bytes(compound(book()))
    (tmp_path / "b.xls").write_bytes(b"not a spreadsheet")
    rows = X.sheet_rows(io.read_binary(spark, str(tmp_path)))
    assert [r.error for r in rows.filter("error is not null").collect()] == ["ValueError: no compound file"]
    got = X.fixed_columns(rows.filter("error is null"), {"mark": 0, "qty": 1, "none": 9}).orderBy("row").collect()
    assert [(r.row, r.mark, r.qty, r.none) for r in got] == [(0, "plain", "breit ü €", None), (1, "2.5", "7", None), (2, None, "1", None), (3, "label", "TRUE", None)]
