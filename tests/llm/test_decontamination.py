import random
import re

import numpy as np
import pyarrow as pa
import pytest

from corpuslink.llm import decontamination as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, width=10):
    windows = {}
    for i, text in items:
        w = words_of(text)
        n = min(width, len(w))
        for at in range(len(w) - n + 1) if w else []:
            windows.setdefault(tuple(w[at : at + n]), set()).add(None if i is None else str(i))
    out = []
    for d, text in docs:
        w, hit, found = words_of(text), set(), set()
        for n in {len(x) for x in windows}:
            for at in range(len(w) - n + 1):
                if tuple(w[at : at + n]) in windows:
                    hit |= set(range(at, at + n))
                    found |= windows[tuple(w[at : at + n])]
        out.append((d, len(w), len(hit), sorted(found - {None})))
    return sorted(out, key=repr)


def found(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.item_ids) for r in df.collect()), key=repr)


def items_table(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "item_id long, text string, doc_id string, n int")


def prose(r, n, vocabulary="a B c é ab 1 Ab x9".split()):
    return "".join(r.choice(vocabulary) + r.choice([" ", "\n", ", ", "-", "\t  "]) for _ in range(n))


ITEMS = [
    (1, "The quick brown fox jumps over the lazy dog again and again"),
    (2, "the quick brown fox jumps over the lazy dog again"),
    (10, "short item"),
    (3, "..."),
    (4, None),
    (5, ""),
    (None, "seven words that nobody has an id"),
    (10, "another row of ten"),
]
DOCS = [
    (1, "so THE quick, brown fox jumps over the (lazy) dog again! and more"),
    (2, "the quick brown fox jumps over the lazy cat again and again"),
    (3, "a short\nitem and a Short-Item, short items"),
    (4, None),
    (5, ""),
    (6, "!!! ...  "),
    (7, "seven words that nobody has an id"),
    (7, "seven words that nobody has an id"),
    (None, "another row of ten another row of ten"),
    (8, "short"),
]


@pytest.mark.parametrize("max_windows", [dc.MAX_WINDOWS, 0])
def test_small_cases_by_both_ways(spark, frame, max_windows):
    got = dc.contamination(frame(DOCS), items_table(spark, ITEMS), max_windows=max_windows)
    assert found(got) == brute(DOCS, ITEMS)


@pytest.mark.parametrize("max_windows", [dc.MAX_WINDOWS, 0])
@pytest.mark.parametrize("seed", [1, 2])
def test_random_texts(spark, frame, seed, max_windows):
    r = random.Random(seed)
    items = [(i, prose(r, r.choice([0, 1, 3, 5, 6, 8]))) for i in range(12)]
    docs = [(i, prose(r, r.choice([0, 2, 5, 40, 300]))) for i in range(60)]
    got = dc.contamination(frame(docs), items_table(spark, items), width=5, max_windows=max_windows)
    assert found(got) == brute(docs, items, 5)


def test_empty_tables(spark, frame):
    empty_items, empty_docs = items_table(spark, []), frame([])
    assert found(dc.contamination(frame(DOCS), empty_items)) == brute(DOCS, [])
    for most in (dc.MAX_WINDOWS, 0):
        assert found(dc.contamination(empty_docs, items_table(spark, ITEMS), max_windows=most)) == []


@pytest.mark.parametrize("size", [16, 40, 200])
def test_long_texts_in_pieces(size):
    r = random.Random(size)
    items = [(i, prose(r, 6)) for i in range(30)]
    held, words = set_of(items, 4), dc.Words()
    texts = [prose(r, n) for n in (1, 30, 500, 2000)]
    whole = list(dc.scans(words, held, pa.array(texts)))
    cut = [dc.scan_long(words, held, np.frombuffer(t.encode(), np.uint8), size) for t in texts]
    assert any(s.spans for s in whole)
    for a, b in zip(whole, cut):
        assert (a.n_words, a.n_hit, a.items, a.spans) == (b.n_words, b.n_hit, b.items, b.spans)


def set_of(items, width):
    lengths, hashes, joined, ids = [], [], [], []
    words = dc.Words()
    for i, text in items:
        data = np.frombuffer(text.encode(), np.uint8)
        words.read(data, np.array([0, len(data)]))
        n = min(width, len(words.starts))
        for at, h in enumerate(words.windows(n)) if n else []:
            lengths.append(n), hashes.append(h), joined.append(words.joined(at, n)), ids.append(str(i))
    return dc.WindowSet(np.array(lengths), np.array(hashes, np.uint64), joined, ids)


def test_a_huge_text_and_a_huge_word(spark, frame):
    """Texts of several blocks and a word larger than a block, in the benchmark as well."""
    r = random.Random(3)
    huge = "q" * (3 << 20)
    passage = " ".join(f"w{i}" for i in range(12))
    long_text = prose(r, 300_000, [f"v{i}" for i in range(500)])
    middle = len(long_text) // 2
    items = [(1, passage), (2, f"before {huge} after"), (3, huge[:-1])]
    docs = [
        (1, long_text[:middle] + " " + passage.upper() + " " + long_text[middle:]),
        (2, f"{passage} before {huge.upper()} after " + passage),
        (3, f"before {huge[:-1]}r after"),
    ]
    got = dc.contamination(frame(docs), items_table(spark, items))
    assert found(got) == brute(docs, items)
    assert [r[2] for r in found(got)] == [12, 27, 0]


def test_equal_hashes_are_no_hits(monkeypatch):
    monkeypatch.setattr(dc.Words, "windows", lambda self, n: np.zeros(max(0, len(self.starts) - n + 1), np.uint64))
    held, words = set_of([(1, "a b c"), (2, "d e f"), (3, "a b c")], 3), dc.Words()
    (scan,) = dc.scans(words, held, pa.array(["x a b c d e y"]))
    assert (scan.n_words, scan.n_hit, scan.items) == (7, 3, {"1", "3"})


@pytest.mark.parametrize("max_windows", [dc.MAX_WINDOWS, 0])
def test_documents_go_or_lose_their_spans(spark, frame, max_windows):
    docs, items = frame(DOCS), items_table(spark, ITEMS)
    left = dc.without_hits(docs, items, max_windows=max_windows)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [2, 4, 5, 6, 8]
    some = dc.without_hits(docs, items, most_hit=4, max_windows=max_windows)
    assert sorted(r.doc_id for r in some.collect()) == [2, 3, 4, 5, 6, 8]
    cut = dc.without_hits(docs, items, remove="spans", max_windows=max_windows)
    assert cut.columns == docs.columns
    texts = [(r.doc_id, r.text) for r in cut.collect()]
    assert len(texts) == len(DOCS)
    assert set(texts) == {
        (1, "so   more"), (2, DOCS[1][1]), (3, "a   and a  , short items"), (4, None), (5, ""), (6, DOCS[5][1]),
        (7, " "), (None, " "), (8, "short"),
    }
    with pytest.raises(ValueError):
        dc.without_hits(docs, items, remove="words")
