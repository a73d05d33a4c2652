import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm.packing import pack_documents, places, plan
from millrace.llm.pretokens import PreTokens
from millrace.llm.token_counts import count_tokens
from millrace.llm.token_output import best_fit_decreasing, op4_token_output, pack_ids, read_shards, write_shards
from millrace.session import Stash

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOK = PreTokens(PATH)
EDGE = [(1, None), (2, ""), (3, "a"), (3, "a"), (None, "no id"), (5, "word " * 3000), (6, "x" * 30000), (7, "tab\tand  two\n spaces \n\n end \xa0"), (8, "中文 а б ² ½ don't we'll <|endoftext|> end"), (9, "\n’ \x1e\x1c"), (10, " lead")]
PIECES = ["abc", "XYZ", " ", "  ", "\n", "\n\n", "\t", "\r", ".", ",", "'s", "’", "!?", "019", "²½", "éßñ", "\xa0", "\x85", "\x1c", "　", "中", "а", "<|endoftext|>", " the", "don't", "ﬁ", "̈", "🙂"]


def ids_of(text):
    return TOK.lib.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=12).map("".join), max_size=8))
def test_ids_equal_the_library(texts):
    for text, ids in zip(texts, TOK.column(pa.array(texts, pa.string())), strict=True):
        assert list(ids) == ids_of(text)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=40))
def test_any_text(text):
    text = text.encode("utf-8", "replace").decode()
    assert list(TOK.ids(text)) == ids_of(text)
    if text and TOK.plain(text):
        assert sum(n * len(r) // 4 for (_, n), r in zip(c.items(), TOK.encode_pieces(list(c)), strict=True)) == len(ids_of(text)) if (c := TOK.counts(text)) else True


def test_generations_change_nothing(monkeypatch):
    monkeypatch.setattr(PreTokens, "KEEP", 50)
    monkeypatch.setattr(PreTokens, "TOGETHER", 200)
    rng, tok = random.Random(1), PreTokens(PATH)
    texts = [" ".join("".join(rng.choice("abcdef,.") for _ in range(rng.randint(1, 6))) for _ in range(20)) for _ in range(100)]
    assert [list(x) for x in tok.column(pa.array(texts))] == [ids_of(t) for t in texts]


def test_counts(spark, tiny):
    for head in (0, 3, 100_000):
        got = sorted(((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in count_tokens(tiny(EDGE), PATH, head=head).collect()), key=repr)
        assert got == sorted(((i, len((t or "").encode()), n := len(ids_of(t)), n > 512) for i, t in EDGE), key=repr)
    assert count_tokens(tiny([]), PATH).count() == 0


def test_op10_whole_table(spark, small):
    from millrace.llm.token_counts import op10_token_counts

    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    assert {(r.doc_id, r.n_tokens) for r in op10_token_counts(spark, small).collect()} == {(r.doc_id, len(ids_of(r.text))) for r in docs}


def check_pieces(rows, docs, size=2048):
    """Every id in one piece, right digests, and gapless sequences."""
    import collections

    want = collections.Counter((i, tuple([*ids_of(t), 1])) for i, t in docs)
    by_doc, by_seq = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id, r.doc_tokens].append(r)
        by_seq[r.sequence_id].append((r.offset, r.length))
    for parts in by_seq.values():
        at = 0
        for off, n in sorted(parts):
            assert off == at and n > 0
            at += n
        assert at <= size
    for (doc, ids), copies in want.items():
        raw = np.array(ids, "<u4").tobytes()
        parts = [r for r in by_doc[doc, len(ids)]]
        seen = collections.Counter((r.start, r.length) for r in parts if zlib.crc32(raw[4 * r.start : 4 * (r.start + r.length)]) == r.ids_crc32)
        at = 0
        while at < len(ids):
            (start, n), k = next((x for x in seen.items() if x[0][0] == at), ((at, 0), 0))
            assert k >= copies and n, (doc, at)
            at += n
    assert sum(r.length for r in rows) == sum(len(i) * k for (_, i), k in want.items())


def test_packing_edges(spark, tiny):
    check_pieces(pack_documents(tiny(EDGE), PATH).collect(), EDGE)
    assert pack_documents(tiny([]), PATH).count() == 0


def test_op9_whole_table(spark, small):
    from millrace.llm.packing import op9_packing

    docs = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    rows = op9_packing(spark, small).collect()
    check_pieces(rows, docs)
    n = len({r.sequence_id for r in rows})
    assert sum(r.length for r in rows) / (2048 * n) > 0.97


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 500), max_size=20))
def test_plan_places_every_piece(histogram):
    patterns = plan(histogram, 64)
    got = {}
    for packs, chain in patterns:
        assert packs > 0 and sum(n * k for n, k in chain) <= 64
        for n, k in chain:
            got[n] = got.get(n, 0) + packs * k
    assert got == histogram
    for n, (first, base, each, off) in places(patterns).items():
        assert first[0] == 0 and first == sorted(first) and max(o + n * e for o, e in zip(off, each, strict=True)) <= 64


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=80))
def test_plan_is_shortest_pack_first(lengths):
    """Against the plain algorithm, one piece at a time."""
    packs = []
    for n in sorted(lengths, reverse=True):
        if packs and min(packs) + n <= 40:
            packs[packs.index(min(packs))] += n
        else:
            packs.append(n)
    got = plan({n: lengths.count(n) for n in lengths}, 40)
    assert sorted(packs) == sorted(sum(n * k for n, k in chain) for count, chain in got for _ in range(count))


def test_plan_alternates():
    assert sorted(sum(n * k for n, k in c) for m, c in plan({60: 1, 58: 1, 10: 4}, 100) for _ in range(m)) == [78, 80]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=60), st.lists(st.integers(1, 31), max_size=5))
def test_best_fit_decreasing(lengths, free):
    rows = best_fit_decreasing(lengths, 32, free)
    assert sorted(i for r in rows for i in r) == list(range(len(lengths)))
    # The plain algorithm: the fullest row that still has room, lengths falling.
    room = list(free)
    for n in sorted(lengths, reverse=True):
        fit = [f for f in room if f >= n]
        if fit:
            room[room.index(min(fit))] -= n
        else:
            room.append(32 - n)
    assert sorted(room) == sorted(f - sum(lengths[i] for i in r) for f, r in zip([*free, *[32] * len(rows)], rows, strict=False))


@pytest.mark.parametrize("window", [1, 5000, 1 << 21])
def test_binary_round_trip(spark, tiny, tmp_path, window):
    packed = pack_ids(tiny(EDGE), PATH, window=window).collect()
    docs = {}
    for r in packed:
        ids = np.frombuffer(bytes(r.ids), "<u2")
        assert len(ids) == 2048 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens and r.position_resets == r.cu_seqlens[:-1]
        assert (ids[r.n_tokens :] == 0).all()
        for doc, start, total, a, b in zip(r.doc_ids, r.starts, r.doc_tokens, r.cu_seqlens, r.cu_seqlens[1:], strict=False):
            docs.setdefault((doc, total), []).append((start, ids[a:b].tolist()))
    for i, t in EDGE:
        want = [*ids_of(t), 1]
        parts = sorted(docs[i, len(want)])
        copies = [(i, t) for i, t in EDGE].count((i, t))
        assert [x for _, p in parts[::copies] for x in p] == want
    assert len({r.sequence_id for r in packed}) == len(packed)
    assert pack_ids(tiny([]), PATH).count() == 0


def test_shards(spark, tiny, tmp_path):
    docs = tiny(EDGE).coalesce(1)
    manifest = write_shards(pack_ids(docs, PATH), f"file://{tmp_path}/out").collect()
    (m,) = manifest
    ids = np.fromfile(tmp_path / "out" / f"{m.name}.ids.bin", "<u2")
    cu = np.fromfile(tmp_path / "out" / f"{m.name}.cu.bin", "<i4")
    pos = np.fromfile(tmp_path / "out" / f"{m.name}.pos.bin", "<i4")
    assert len(ids) == 2048 * m.n_rows
    total = sum(len(ids_of(t)) + 1 for _, t in EDGE)
    at = n = begin = 0
    while at < len(cu):
        k = cu[at]
        assert cu[at + 1] == 0
        assert pos[begin] == k - 1 and (pos[begin + 1 : begin + k] == cu[at + 1 : at + k]).all()
        n += cu[at + k]
        at, begin = at + k + 1, begin + k
    assert n == total == m.n_tokens and begin == len(pos)


@pytest.mark.parametrize("file_rows", [1, 3, 8192])
def test_shards_read_back(spark, tiny, tmp_path, file_rows):
    packed = Stash(spark, "t").put(pack_ids(tiny(EDGE).repartition(2), PATH))
    url = f"file://{tmp_path}/out"
    manifest = Stash(spark, "t").put(write_shards(packed, url, file_rows))
    row = lambda r: (r.sequence_id, r.n_tokens, bytes(r.ids), tuple(r.cu_seqlens), tuple(r.position_resets), tuple(r.doc_ids), tuple(r.starts), tuple(r.doc_tokens))
    assert sorted(map(row, read_shards(manifest, url).collect())) == sorted(map(row, packed.collect()))
    assert max(r.n_rows for r in manifest.collect()) <= file_rows
    assert read_shards(write_shards(pack_ids(tiny([]), PATH), url), url).count() == 0
    name = manifest.first()["name"]
    (tmp_path / "out" / f"{name}.ids.bin").write_bytes(b"spoilt")
    with pytest.raises(Exception, match="not what the manifest says"):
        read_shards(manifest, url).count()


def test_ids_that_do_not_fit(spark, tiny):
    with pytest.raises(Exception, match="don't fit"):
        pack_ids(tiny(EDGE), PATH, dtype="u1").count()


def test_op4_whole_table(spark, small):
    docs = {r.doc_id: [*ids_of(r.text), 1] for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()}
    got = {}
    rows = op4_token_output(spark, small).collect()
    for r in rows:
        ids = np.frombuffer(bytes(r.ids), "<u2")
        for doc, start, total, a, b in zip(r.doc_ids, r.starts, r.doc_tokens, r.cu_seqlens, r.cu_seqlens[1:], strict=False):
            got.setdefault(doc, []).append((start, ids[a:b].tolist()))
            assert total == len(docs[doc])
    assert {i: [x for _, p in sorted(parts) for x in p] for i, parts in got.items()} == docs
    assert len({r.sequence_id for r in rows}) == len(rows)
