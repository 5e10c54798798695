"""Obfuscated words of every length and spacing."""

import pytest

pytest.importorskip("lexgraph.llm")
from lexgraph.llm import toxicity  # noqa: E402


@pytest.fixture()
def find(docs):
    text = "you are a stupid idiot and he is a moron or a dumb sod but the old man and his red dog ran to the hill in the sun as it set on idiots all " * 20
    model = toxicity.Model(toxicity.trigram_counts(docs([(1, text)])), {"idiot": 3.0, "idiot*": 3.0, "moron": 2.0, "stupid": 2.5, "sod": 1.5}, toxicity.np.zeros(4))
    of = model.scorer()

    def words(x):
        return sorted(w for b in of(x)[1] for w in b.split("=", 1)[1].split())

    return words


SPACED = {
    "he is m o r o n!": ["moron"], "he is (m o r o n), see": ["moron"], "he is a m o r o n now": ["moron"], "s t u p i d i d i o t": ["idiot", "stupid"], "m\to\nr  o n": ["moron"],
    "you s o d then": ["sod"], "1 d 1 0 t": ["idiot"], "i d i o t s": ["idiots"], "1d10ts": ["idiots"], "t h e o l d m a n": [], "a b c": [],
}


@pytest.mark.parametrize("text", SPACED)
def test_spacing(find, text):
    assert find(text) == SPACED[text]


LONG = {
    "an idi" + "o" * 45 + "t": ["idiot"], "m" + "0" * 90 + "ron": ["moron"], "stup1d1d10tm0r0n" * 4: ["idiot", "moron", "stupid"] * 4, "1d10t-" * 20: ["idiot"] * 20,
    " ".join("heisastupidmanandthereddograntothehillandthemoronsatonit"): ["moron", "stupid"], "-".join("theoldmanandhisreddograntothehillandidiot"): ["idiot"],
    " ".join("theoldmanandhisreddograntothehill" * 3): [], "ab1" * 20_000: [],
}


@pytest.mark.parametrize("text", LONG)
def test_length(find, text):
    assert find(text) == sorted(LONG[text])


def test_decoding_against_all_readings(docs):
    """The k likeliest texts of a lattice, by enumeration of all its paths."""
    import itertools

    channel = toxicity.Channel(toxicity.trigram_counts(docs([(1, "you are a stupid idiot and he is a moron or a dumb sod " * 9)])))
    for word in ("1d10t", "m0r0n", "stup1d", "s$!|*", "a***b", "iiiidiooot", "m.0.r", "!!!!"):
        lattice = channel.lattice(word)
        best = {}
        for path in itertools.product(*lattice):
            text, x, y, score = "".join(t for t, _ in path), 0, 0, sum(c for _, c in path)
            for ch in text:
                c = ord(ch) - 96
                score += channel.log_p[x][y][c]
                x, y = y, c
            best[text] = max(best.get(text, -1e9), score + channel.log_p[x][y][0])
        want = sorted(best.values(), reverse=True)[:6]
        got = channel.search(lattice, 6)
        assert len(got) == len(set(got)) == min(6, len([t for t in best if t]))
        assert toxicity.np.allclose([best[t] for t in got], want[: len(got)])
