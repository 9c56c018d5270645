"""Texts and comparisons shared by the tests."""

import random

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def odd_texts() -> list:
    rnd = random.Random(3)
    words = "the of and thing ening Über naïve été can't x1 <|endoftext|> 日本語 ok!! # $ | 42".split(" ")
    mixed = ["".join(rnd.choice(" abcétT\n.!<ßあ1\t'") for _ in range(rnd.randrange(150))) for _ in range(40)]
    prose = [" ".join(rnd.choice(words) for _ in range(n)) for n in (1, 2, 3, 8, 30, 300)]
    return [None, "", " ", "\n\n", "  a  b \n\n c", "one", "a\xa0b  c", "x\x1cy \x1c z", "ΑΣ Σ", "é a", "a" * 3000,
            " ".join(["again"] * 900), "line one here\n" * 40, *mixed, *prose, prose[-1], prose[-1] + " end",
            " ".join(rnd.choice(words) for _ in range(20_000))]


def key(row):
    return tuple((x is not None, x) for x in row)


def same(a, b) -> bool:
    return sorted(map(key, map(tuple, a))) == sorted(map(key, map(tuple, b)))
