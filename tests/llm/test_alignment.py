import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from corpuslink.llm import alignment as al

PATHS = al.default_tokenizers()


class Plain:
    """Both libraries on whole texts, one text at a time."""

    def __init__(self):
        self.a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
        keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
        chars = [chr(b) if b in keep else None for b in range(256)]
        extra = iter(range(256, 512))
        chars = [c if c else chr(next(extra)) for c in chars]
        self.byte = {c: b for b, c in enumerate(chars)}

    def tokens(self, text):
        """Ids and end bytes of both sides, or None."""
        if not text:
            return None
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text)
        spell_a = [bytes(self.byte[c] for c in self.a.id_to_token(i)) for i in a]
        spell_b = []
        for i in b:
            piece = self.b.id_to_piece(i)
            byte = len(piece) == 6 and piece.startswith("<0x") and self.b.is_byte(i)
            spell_b.append(bytes([int(piece[3:5], 16)]) if byte else piece.replace("▁", " ").encode())
        whole = (" " + text).encode()
        if b"".join(spell_a) != whole or b"".join(spell_b) != whole:
            return None
        return a, np.cumsum([len(x) for x in spell_a]).tolist(), b, np.cumsum([len(x) for x in spell_b]).tolist()

    def groups(self, text):
        found = self.tokens(text)
        if found is None:
            return []
        a, end_a, b, end_b = found
        out, i, j, start = [], 0, 0, 0
        for end in sorted(set(end_a) & set(end_b)):
            p, q = end_a.index(end) + 1, end_b.index(end) + 1
            out.append((a[i:p], b[j:q], start, end))
            i, j, start = p, q, end
        return out


PLAIN = Plain()


def brute(rows):
    groups = [(d, PLAIN.groups(t)) for d, t in rows]
    count = Counter((g[0][-1], g[1][-1]) for _, gs in groups for g in gs)
    highest = {}
    for (_, b), n in count.items():
        highest[b] = max(n, highest.get(b, 0))
    out = []
    for d, gs in groups:
        links = [(g[0][-1], g[1][-1]) for g in gs]
        text = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in gs)
        out.append((
            d, sum(len(g[0]) for g in gs), sum(len(g[1]) for g in gs), len(gs), len(links),
            sum(count[x] == highest[x[1]] for x in links), sum(count[x] for x in links),
            hashlib.sha256(text.encode()).hexdigest() if gs else "",
        ))
    return sorted(out, key=repr)


def found(df):
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


ODD = [
    "hi  there\n\nx", " lead", "  two", "tail  ", " ", "   ", "a\tb \t c", "<s>x</s> <unk> <0x41> <|endoftext|> x", "ﬁ ½ é é",
    "x\xa0y \xa0 z 　", "▁q a ▁ b", "日本語 と 中文", "\x00a \x7f", "\r\n", "don't can't 's 'll I'll", "a" * 300, "1234567 89 0,5 €",
    "naïve café ÷ × Ã ", "😀 😀😀 ‍", "it 's  x", "é é éé", "A B\u0085 C", "", None,
]


def texts(seed, n):
    r = random.Random(seed)
    words = ["the", "Über", "naïve", "don't", "x1", "---", "日本", "🙂", "ingly", "a", "▁", "3.14", "<s>", "q" * 40]
    gaps = [" "] * 12 + ["  ", "\n", " \n ", "\t", ", ", "\xa0", " \xa0", "　"]
    return ["".join(r.choice(words) + r.choice(gaps) for _ in range(r.choice([1, 5, 60, 400]))) for _ in range(n)]


@pytest.mark.parametrize("step", [1, 2, 7, 64, 10_000])
def test_pieces_of_the_merge_give_the_merge(step):
    r = np.random.default_rng(step)
    for _ in range(60):
        n = int(r.integers(0, 200))
        a, b = (np.flatnonzero(np.append(r.random(n) < p, True)) + 1 for p in r.random(2))
        over_a, over_b, cut_a, cut_b = al.merge_pieces(a, b, step)
        edges = sorted({*a.tolist(), *b.tolist()})
        want = [(int(np.searchsorted(a, e)), int(np.searchsorted(b, e))) for e in edges]
        assert list(zip(over_a.tolist(), over_b.tolist())) == want
        common = sorted(set(a.tolist()) & set(b.tolist()))
        assert cut_a.tolist() == [int(np.searchsorted(a, e)) + 1 for e in common]
        assert cut_b.tolist() == [int(np.searchsorted(b, e)) + 1 for e in common]


def test_pieces_are_of_equal_work():
    a, b = np.arange(1, 1001) * 3, np.arange(1, 301) * 10
    i = al.crossings(a, b, 64)
    j = np.append(np.arange(0, 1300, 64), 1300) - i
    assert set(np.diff(i + j)[:-1].tolist()) == {64}
    assert (a[i[1:-1] - 1] <= b[np.minimum(j[1:-1], 299)]).all() and (b[j[1:-1] - 1] < a[np.minimum(i[1:-1], 999)]).all()


def test_ids_are_those_of_whole_texts():
    encoder = al.PairEncoder(*PATHS)
    for group in (ODD, texts(1, 60), ODD + texts(2, 30)):
        rows = [t or "" for t in group]
        got = [[], []]
        for low, high, one, _ in al.aligned_texts(encoder, pa.array(rows)):
            for k in range(high - low):
                got[0].append(one.a[one.text_a[k] : one.text_a[k + 1]].tolist())
                got[1].append(one.b[one.text_b[k] : one.text_b[k + 1]].tolist())
        for t, a, b in zip(rows, *got):
            plain = PLAIN.tokens(t)
            assert (a, b) == ((plain[0], plain[2]) if plain else ([], []))


def test_documents(spark, frame):
    rows = list(enumerate(ODD + texts(3, 40))) + [(3, "hi  there\n\nx"), (None, "the the the")]
    assert found(al.aligned_documents(frame(rows))) == brute(rows)


@pytest.mark.parametrize("size,count_bytes", [(64, 1), (200, 4000), (3000, 1 << 24)])
def test_long_texts_and_small_blocks(spark, frame, size, count_bytes):
    rows = list(enumerate(texts(4, 30) + [" ".join(texts(5, 20)), "x" * 5000, "ab " * 3000, ODD[10] + " x y" * 500]))
    assert found(al.aligned_documents(frame(rows), size=size, count_bytes=count_bytes)) == brute(rows)


def test_groups_as_rows(spark, frame):
    rows = list(enumerate(ODD + texts(6, 10)))
    got = sorted((r.doc_id, r.group_no, r.a_ids, r.b_ids, r.start, r.end) for r in al.token_groups(frame(rows)).collect())
    want = sorted((d, k, *g) for d, t in rows for k, g in enumerate(PLAIN.groups(t)))
    assert got == want


def test_empty_tables(spark, frame):
    assert al.aligned_documents(frame([])).collect() == []
    assert found(al.aligned_documents(frame([(1, None), (2, "")]))) == brute([(1, None), (2, "")])
    assert al.token_groups(frame([(1, None)])).collect() == []
