"""Rows of legacy spreadsheets (BIFF8 records in a compound file), as published in the formats' specifications."""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The compound file's mark and ends of chains, and the records that are read.
MAGIC, ENDS = bytes.fromhex("D0CF11E0A1B11AE1"), 0xFFFFFFFA
BOF, EOF, SHEET, STRINGS, CONTINUE, FROM_STRINGS, LABEL, NUMBER, RK, MANY_RK, FORMULA, RESULT, BOOL = 0x809, 0x0A, 0x85, 0xFC, 0x3C, 0xFD, 0x204, 0x203, 0x27E, 0xBD, 0x06, 0x207, 0x205


def workbook(raw: bytes) -> bytes:
    """The stream `Workbook` (or `Book`) of a compound file."""
    if raw[:8] != MAGIC:
        raise ValueError("no compound file")
    big, small = (1 << s for s in struct.unpack_from("<HH", raw, 30))
    (first_dir,), (cutoff, first_mini, _, more, _) = struct.unpack_from("<I", raw, 48), struct.unpack_from("<5I", raw, 56)
    sector = lambda n: raw[(n + 1) * big : (n + 2) * big]
    table = [x for x in struct.unpack_from("<109I", raw, 76) if x < ENDS]
    while more < ENDS:
        part = struct.unpack(f"<{big // 4}I", sector(more))
        table += [x for x in part[:-1] if x < ENDS]
        more = part[-1]
    fat = [x for n in table for x in struct.unpack(f"<{big // 4}I", sector(n))]

    def chain(n, links, get):
        out, seen = [], 0
        while n < ENDS and seen <= len(links):
            out.append(get(n))
            n, seen = links[n], seen + 1
        return b"".join(out)

    entries = chain(first_dir, fat, sector)
    found, root = None, None
    for at in range(0, len(entries), 128):
        name = entries[at : at + max(0, struct.unpack_from("<H", entries, at + 64)[0] - 2)].decode("utf-16-le", "replace")
        place = struct.unpack_from("<II", entries, at + 116)
        root = place if entries[at + 66] == 5 else root
        found = place if name in ("Workbook", "Book") else found
    if found is None:
        raise ValueError("no workbook in the file")
    start, size = found
    if size >= cutoff:
        return chain(start, fat, sector)[:size]
    mini = chain(root[0], fat, sector)
    links = struct.unpack(f"<{len(m := chain(first_mini, fat, sector)) // 4}I", m)
    return chain(start, links, lambda n: mini[n * small : (n + 1) * small])[:size]


def _strings(parts: list[bytes]) -> list[str]:
    """The shared strings; a string may go on in the next record, which tells anew how its characters are stored."""
    part, at, out = 0, 8, []

    def take(n):
        nonlocal part, at
        got = b""
        while len(got) < n:
            if at >= len(parts[part]):
                part, at = part + 1, 0
            piece = parts[part][at : at + n - len(got)]
            got, at = got + piece, at + len(piece)
        return got

    for _ in range(struct.unpack_from("<I", parts[0], 4)[0]):
        left, flags = struct.unpack("<HB", take(3))
        runs = struct.unpack("<H", take(2))[0] if flags & 8 else 0
        extra = struct.unpack("<I", take(4))[0] if flags & 4 else 0
        text, wide = "", flags & 1
        while left:
            if at >= len(parts[part]):
                part, at = part + 1, 1
                wide = parts[part][0] & 1
            n = min(left, (len(parts[part]) - at) // (2 if wide else 1))
            text += take(n * (2 if wide else 1)).decode("utf-16-le" if wide else "latin-1")
            left -= n
        take(4 * runs + extra)
        out.append(text)
    return out


def _number(v: float) -> str:
    return str(int(v)) if v == int(v) and abs(v) < 1e15 else repr(v)


def _rk(n: int) -> float:
    v = float(n >> 2) if n & 2 else struct.unpack("<d", struct.pack("<Q", (n & 0xFFFFFFFC) << 32))[0]
    if n & 2 and n >> 31:
        v -= 1 << 30
    return v / 100 if n & 1 else v


def cells(raw: bytes):
    """(sheet, row, column, value) of a file's cells, as text."""
    stream, at, records = workbook(raw), 0, []
    while at + 4 <= len(stream):
        kind, n = struct.unpack_from("<HH", stream, at)
        records.append((at, kind, stream[at + 4 : at + 4 + n]))
        at += 4 + n
    names, strings = {}, []
    for i, (_, kind, data) in enumerate(records):
        if kind == SHEET:
            names[struct.unpack_from("<I", data)[0]] = data[8 : 8 + data[6] * (1 + (data[7] & 1))].decode("utf-16-le" if data[7] & 1 else "latin-1")
        elif kind == STRINGS:
            parts = [data]
            for _, more, rest in records[i + 1 :]:
                if more != CONTINUE:
                    break
                parts.append(rest)
            strings = _strings(parts)
    sheet, waiting = None, None
    for begin, kind, data in records:
        if kind == BOF:
            sheet = names.get(begin)
        if sheet is None or len(data) < 4:
            continue
        row, col = struct.unpack_from("<HH", data)
        if kind == FROM_STRINGS:
            yield sheet, row, col, strings[struct.unpack_from("<I", data, 6)[0]]
        elif kind == LABEL:
            n, wide = struct.unpack_from("<HB", data, 6)
            yield sheet, row, col, data[9 : 9 + n * (1 + (wide & 1))].decode("utf-16-le" if wide & 1 else "latin-1")
        elif kind == NUMBER:
            yield sheet, row, col, _number(struct.unpack_from("<d", data, 6)[0])
        elif kind == RK:
            yield sheet, row, col, _number(_rk(struct.unpack_from("<I", data, 6)[0]))
        elif kind == MANY_RK:
            for k in range((len(data) - 6) // 6):
                yield sheet, row, col + k, _number(_rk(struct.unpack_from("<I", data, 6 + 6 * k)[0]))
        elif kind == BOOL and not data[7]:
            yield sheet, row, col, "TRUE" if data[6] else "FALSE"
        elif kind == FORMULA:
            if data[12:14] == b"\xff\xff":
                waiting = (row, col) if data[6] == 0 else None
            else:
                yield sheet, row, col, _number(struct.unpack_from("<d", data, 6)[0])
        elif kind == RESULT and waiting:
            n, wide = struct.unpack_from("<HB", data)
            yield sheet, *waiting, data[3 : 3 + n * (1 + (wide & 1))].decode("utf-16-le" if wide & 1 else "latin-1")
            waiting = None


def sheet_rows(files: DataFrame) -> DataFrame:
    """(path, sheet, row, cells, error) of read_binary() files: a row's values by column; a file that can't be read is one row with its error."""

    def run(batches):
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                rows: dict = {}
                try:
                    for sheet, row, col, value in cells(bytes(content)):
                        rows.setdefault((sheet, row), {})[col] = value
                    out = [(path, s, r, list(v.items()), None) for (s, r), v in sorted(rows.items())]
                except (ValueError, IndexError, struct.error, KeyError) as e:
                    out = [(path, None, None, None, f"{type(e).__name__}: {e}")]
                yield pd.DataFrame(out, columns=["path", "sheet", "row", "cells", "error"]).astype({"row": "Int64"})

    return files.select("path", "content").mapInPandas(run, "path string, sheet string, row long, cells array<struct<col: int, value: string>>, error string")


def fixed_columns(rows: DataFrame, columns: dict[str, int]) -> DataFrame:
    """(path, sheet, row) and the named columns of sheet_rows(); missing cells are null."""
    by = F.map_from_entries(F.coalesce("cells", F.array().cast("array<struct<col: int, value: string>>")))
    return rows.select("path", "sheet", "row", *(F.try_element_at(by, F.lit(i)).alias(n) for n, i in columns.items()))
