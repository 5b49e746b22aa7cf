"""Texts for the tests of the training-data operators."""

WORDS = "the old river bends past seven quiet mills before it meets a wide grey lake near some hills".split()

#: Columns that operators use inside, with other content.
CLASHING = "row h n key rep a b items words places print part doc label score hits kept_0 comp".split()


def sentence(k: int, n: int = 12) -> str:
    """n words that depend on k."""
    return " ".join(f"{WORDS[(k * 7 + j * j + j) % len(WORDS)]}{(k + j) % 97}" for j in range(n))


def text(k: int, lines: int = 5) -> str:
    return "\n".join(sentence(100 * k + j) for j in range(lines))
