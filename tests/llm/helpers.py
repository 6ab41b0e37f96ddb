"""Texts and rows that several tests of the corpus operators share."""

SF = "/root/testdata/sf0.001"
WORDS = "the of and river stone light under copper garden window letter morning seven paper green cloud été über niño cold".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + (rng.choice([",", ".", ""]) if rng.random() < 0.2 else "") for _ in range(n))


ODD_TEXTS = [None, "", " \t\n ", "a", "one two three", "x" * 70_000, "é ü    y\r\n\r\nz", "\x1c#*$ <b>&amp;", "日本語 " * 40, "same same same same same"]


def pairs_of(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
