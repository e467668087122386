import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpuslink.llm import huffman, packing
from corpuslink.llm.tokens import END_ID, PieceEncoder, default_tokenizer
from corpuslink.session import shared_folder

ODD = [
    None, "", " ", "\n", "a", "  a", "a\n\nb", "é b c", "x 　 y", "a<|endoftext|>b", "a b c's 12 3\n4 \t5",
    "a,b.c 1.2,3 é,ñ.,'s,. .x", "don't.’s,…,,", "a\tb", "x’s —, y z", "😀 zwölf, Boxkämpfer.\nJagen",
]


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(default_tokenizer())
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    parts = ["a", "é", "…", " ", "\n", ",", ".", "'s", "1", "Z", "\t", "ß", "<", "|", "x, ", "字", "word ", "Word."]
    made = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    return ODD + made + ["word, next. " * 3000 + "end", ODD[11], ODD[11]]


def test_pieces_give_the_ids_of_whole_texts(texts, whole):
    run = PieceEncoder(default_tokenizer())
    for _ in range(2):  # the second time every piece is known
        ids, lengths = [], []
        for _, _, some, counts in run.encode(pa.array(texts)):
            ids += some.tolist()
            lengths += counts.tolist()
        assert lengths == [len(whole(t)) for t in texts]
        assert ids == [i for t in texts for i in whole(t)]


def test_token_files_round_trip(spark, frame, texts, whole, monkeypatch):
    rows = list(enumerate(texts))
    random.Random(1).shuffle(rows)
    folder = shared_folder(spark, "test-files")
    huffman.write_ids(frame(rows).repartition(5), folder)
    got = {r.doc_id: r for r in huffman.read_ids(spark, folder, with_ids=True).collect()}
    before = 0
    for i, text in enumerate(texts):
        ids = whole(text) + [END_ID]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32, got[i].ids) == (before, len(ids), crc, ids)
        before += len(ids)


def test_token_files_of_no_documents_and_of_repeated_ids(spark, frame):
    folder = shared_folder(spark, "test-files")
    huffman.write_ids(frame([]), folder)
    assert huffman.read_ids(spark, folder).count() == 0
    folder = shared_folder(spark, "test-files")
    huffman.write_ids(frame([(7, "a b"), (7, "a b"), (None, "c")]), folder)
    got = sorted((r.doc_id or -1, r.start, r.n_tokens) for r in huffman.read_ids(spark, folder).collect())
    assert [g[0] for g in got] == [-1, 7, 7] and sorted(g[1] for g in got) == [0, 2, 5]


def _cheapest(counts):
    import heapq

    heap = [int(c) for c in counts if c]
    heapq.heapify(heap)
    cost = 0
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    return cost


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 10**6), min_size=2, max_size=80))
def test_code_lengths(counts):
    counts = np.array(counts)
    used = int((counts > 0).sum())
    lengths = huffman.code_lengths(counts, 40)
    if used >= 2:
        assert int((lengths * counts).sum()) == _cheapest(counts)
        short = huffman.code_lengths(counts, 7)
        assert short.max() <= 7 and (2.0 ** -short[short > 0].astype(float)).sum() <= 1
        codes = huffman.canonical_codes(short)
        table = huffman.decode_table(short, 7)
        ids = np.repeat(np.flatnonzero(counts), 3)
        stream, n_bytes, offsets, stops = huffman.encode(ids, np.array([len(ids)]), codes, short)
        assert huffman.decode(stream, offsets, np.array([len(ids)]), table, 7).tolist() == ids.tolist()
    assert huffman.code_lengths(np.array([0, 5]), 7).tolist() == [0, 1]


def test_packed_pieces(frame, texts, whole):
    rows = list(enumerate(texts))
    packed = packing.pack_documents(frame(rows), max_tokens=64, max_segments=6).collect()
    ids = {i: np.array(whole(t) + [END_ID], "<u4") for i, t in rows}
    sequences = {}
    covered = {i: 0 for i in ids}
    for r in sorted(packed, key=lambda r: (r.doc_id, r.start)):
        assert r.start == covered[r.doc_id]
        covered[r.doc_id] += r.length
        assert r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
        sequences.setdefault(r.sequence_id, []).append(r)
    assert covered == {i: len(x) for i, x in ids.items()}
    for held in sequences.values():
        held.sort(key=lambda r: r.offset)
        assert len(held) <= 6
        at = 0
        for r in held:
            assert r.offset == at
            at += r.length
        assert at <= 64
    total = sum(len(x) for x in ids.values())
    assert len(sequences) * 64 <= 1.1 * total + 64 * max(1, len(rows) / 6)


def test_packing_under_three_limits(spark):
    rng = random.Random(2)
    rows = [(i, rng.randint(1, 90), 1, rng.randint(0, 40)) for i in range(500)]
    examples = spark.createDataFrame(rows, "id long, tokens long, segments long, loss long").repartition(3)
    limits = {"tokens": 100, "segments": 5, "loss": 50}
    from corpuslink.session import cut_lineage

    got = packing.pack_examples(cut_lineage(examples), limits, group_items=200).collect()
    assert sorted(r.id for r in got) == list(range(500))
    for name, limit in limits.items():
        sums = {}
        for r in got:
            sums[r.sequence_id] = sums.get(r.sequence_id, 0) + r[name]
        assert max(sums.values()) <= limit
    with pytest.raises(Exception, match="exceeds"):
        packing.pack_examples(cut_lineage(examples), limits | {"tokens": 50}).collect()


def test_packing_of_no_documents(frame):
    assert packing.pack_documents(frame([])).count() == 0
    (only,) = packing.pack_documents(frame([(1, None)])).collect()
    assert (only.length, only.doc_tokens, only.offset) == (1, 1, 0)


def test_packing_with_clashing_names_and_null_demands(spark):
    rows = [(i, i % 7 + 1, None if i % 5 == 0 else i % 3, *"abcdef") for i in range(300)]
    schema = "id long, size int, loss int, _row string, _group string, __row string, sequence_id string, offset string, shard string"
    examples = spark.createDataFrame(rows, schema)
    got = packing.pack_examples(examples, {"size": 20, "loss": 6}, group_items=64)
    assert sorted(got.columns) == sorted(examples.columns)
    held = got.collect()
    assert sorted(r.id for r in held) == list(range(300)) and {r["_row"] for r in held} == {"a"} and {r.shard for r in held} == {"f"}
    by = {}
    for r in held:
        by.setdefault(r.sequence_id, []).append(r)
    for own in by.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == [sum(x.size for x in own[:i]) for i in range(len(own))]
        assert sum(r.size for r in own) <= 20 and sum(r.loss or 0 for r in own) <= 6
    with pytest.raises(ValueError):
        packing.pack_examples(examples, {"offset": 3})


def test_placing_follows_the_plain_heuristic():
    """Step by step: of the examples that fit, one whose demand points most along the room; a new
    sequence only where none fits."""
    r = np.random.default_rng(5)
    for _ in range(20):
        limits = np.array([30, 6, 12])
        demands = np.stack([r.integers(1, 20, 60), r.integers(1, 3, 60), r.integers(0, 9, 60)], axis=1)
        sequence, turn = packing.place(demands, limits)
        assert sorted(turn.tolist()) == list(range(60))
        open_, room, now = set(range(60)), limits.copy(), 0
        for item in np.argsort(turn).tolist():
            fits = [i for i in open_ if (demands[i] <= room).all()]
            if not fits:
                now, room = now + 1, limits.copy()
                fits = list(open_)
            score = {i: float((demands[i] / limits) @ (room / limits)) for i in fits}
            assert sequence[item] == now and score[item] >= max(score.values()) - 1e-9
            open_.remove(item)
            room = room - demands[item]
