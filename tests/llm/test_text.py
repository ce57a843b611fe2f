import numpy as np
import pyarrow as pa
from fixtures import LOWER, awkward, split
from hypothesis import given, settings
from hypothesis import strategies as st

from shardloom.llm.text import pieces, rolling, words

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB é\n\t\x0b\x1f ß|", max_size=40)), max_size=8)


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_words_equal_the_pattern(texts):
    found = words(pa.array(texts, pa.string()))
    assert found.counts.tolist() == [len(split(t)) for t in texts]
    assert found.strings().to_pylist() == [w for t in texts for w in split(t)]
    low = words(pa.array(texts, pa.string()), lower=True)
    assert low.strings().to_pylist() == [w for t in texts for w in split((t or "").translate(LOWER))]


@settings(max_examples=100, deadline=None)
@given(TEXTS)
def test_hashes_depend_on_the_word_alone(texts):
    found = words(pa.array(texts, pa.string()))
    strings = found.strings().to_pylist()
    for which in (0, 1):
        hashes = found.hashes(which).tolist()
        assert len(set(zip(strings, hashes))) == len(set(strings)) == len(set(hashes))


def test_sliced_arrays_and_pieces():
    texts = pa.array([r[1] for r in awkward()])
    batch = pa.RecordBatch.from_arrays([texts], ["t"])
    cut = list(pieces(batch, "t", 1000))
    assert sum(p.num_rows for p in cut) == len(texts) and len(cut) > 3
    whole = [w for p in cut for w in words(p.column(0)).strings().to_pylist()]
    assert whole == words(texts).strings().to_pylist()
    assert words(texts[3:5]).strings().to_pylist() == split(texts[3].as_py()) + split(texts[4].as_py())


def test_rolling_finds_equal_runs():
    values = np.array([5, 6, 7, 5, 6, 7, 8], np.uint64)
    runs = rolling(values, 3).tolist()
    assert runs[0] == runs[3] and len(set(runs)) == 4
    assert len(rolling(values, 9)) == 0
