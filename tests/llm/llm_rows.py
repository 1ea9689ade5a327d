"""Rows with the hard cases, shared by the tests."""

WORDS = "alpha beta gamma delta omega kappa sigma theta über naïve zwölf 漢字 run stop".split()
LONG_LINE = "this line of boilerplate is repeated all over"
PASSAGE = " ".join(f"{WORDS[i * 7 % len(WORDS)]}{i}" for i in range(60))


def text(seed: int, n: int) -> str:
    """Prose of n words that differs by seed."""
    return " ".join(f"{WORDS[(seed * 31 + i * i) % len(WORDS)]}{(seed * 17 + i) % 97}" for i in range(n))


ROWS = (
    [(i, text(i, 20 + 5 * i)) for i in range(12)]
    + [(20, None), (21, ""), (22, " \t\n"), (23, text(3, 35)), (24, text(3, 35)),  # nulls, empty, copies
       (25, text(3, 34) + " changed"), (26, "one"), (27, "a\nb\n\n"), (28, "🙂" * 30)]
    + [(30 + i, f"{text(40 + i, 8)}\n  {LONG_LINE.upper() if i % 2 else LONG_LINE}\t\n{PASSAGE}") for i in range(4)]
    + [(40, "mit license " * 3 + text(9, 100) + " Released under the MIT-License."), (41, text(50, 30_000)),
       (41, text(50, 30_000)), (42, text(7, 70)), (42, text(8, 70)), (None, PASSAGE)]  # long, repeated ids, null id
)
