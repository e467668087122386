"""Texts longer than a block give what short ones give, in memory that does not grow with them."""

import random
import subprocess
import sys

import numpy as np
import pyarrow as pa
import pytest

from corpuslink.llm import tokens, wordhash


def texts(seed):
    r = random.Random(seed)
    words = ["the", "Über", "naïve", "don't", "x1", "---", "日本", "🙂", "A", "q" * 70, "a,b.", "3.14", "<|endoftext|>"]
    gaps = [" "] * 12 + ["  ", "\n", " \n ", "\t", "\xa0", "　"]
    made = ["".join(r.choice(words) + r.choice(gaps) for _ in range(r.choice([1, 40, 400]))) for _ in range(12)]
    return [*made, "", " ", "z" * 500, " " * 300, "no blank here".replace(" ", "-") * 40, "one two " * 100, "日本語" * 90]


@pytest.mark.parametrize("size", [16, 64, 300])
@pytest.mark.parametrize("separators", [wordhash.white_space(), wordhash.not_letters()])
def test_words_in_pieces(size, separators):
    hasher = wordhash.WordHasher(separators)
    raw = [t.encode() for t in texts(size)]
    data = np.frombuffer(b"".join(raw), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(b) for b in raw])])
    whole, cut = hasher.words(data, offsets), hasher.words(data, offsets, size)
    assert whole[0].tolist() == cut[0].tolist() and whole[1].tolist() == cut[1].tolist()


@pytest.mark.parametrize("size", [16, 64, 300])
def test_ids_in_pieces(size):
    encoder = tokens.PieceEncoder(tokens.default_tokenizer())
    column = pa.array(texts(size + 1))
    ids = lambda n: [x for *_, found, counts in encoder.encode(column, n) for x in np.split(found, np.cumsum(counts)[:-1])]
    assert [x.tolist() for x in ids(size)] == [x.tolist() for x in ids(1 << 20)]
    plain = [encoder.tokenizer.encode(t.as_py(), add_special_tokens=False).ids for t in column]
    assert [x.tolist() for x in ids(size)] == plain


MEASURE = """
import resource, sys
import numpy as np, pyarrow as pa
from corpuslink.llm import tokens, wordhash
r = np.random.default_rng(1)
words = np.array(["w%d" % i for i in range(50_000)])
text = pa.array([" ".join(words[r.integers(0, 50_000, 1_000_000)].tolist()) * 6])
n = len(text[0].as_py())
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
if sys.argv[1] == "shingles":
    hasher = wordhash.WordHasher(wordhash.white_space())
    for _, _, data, offsets in wordhash.blocks(text):
        found = wordhash.shingles(*hasher.words(data, offsets), 5)
else:
    encoder = tokens.PieceEncoder(tokens.default_tokenizer())
    found = list(encoder.encode(text))
print(n, (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) * 1024 // n)
"""


@pytest.mark.parametrize("what,most", [("shingles", 12), ("ids", 16)])
def test_memory_for_a_long_text(what, most):
    """Bytes of memory for each byte of one text of about 40 MB, its tables included."""
    run = subprocess.run([sys.executable, "-c", MEASURE, what], capture_output=True, text=True, check=True)
    n, each = map(int, run.stdout.split())
    assert n > 30_000_000 and each <= most
