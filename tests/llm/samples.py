"""Documents that the tests share."""

import random

COLUMNS = (
    "doc_id long, text string, lang string, source string, n_chars long, score double, shard string, spans string, "
    "node string, row string, n_words long, kept boolean, class string, part int, sequence_id long, host string"
)
VOCABULARY = [a + b for a in ("ka", "lo", "mi", "ru", "te", "sa", "no", "vi") for b in ("ten", "rim", "dal", "po", "x", "gu", "ne")]


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(VOCABULARY) + (rng.choice("abcdefgh") * rng.randint(0, 2)) for _ in range(n))


def odd_rows():
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows and ids, columns with clashing names."""
    shared = prose("shared", 80)
    texts = [
        (1, shared + " " + prose(1, 60)), (2, prose(2, 60) + "\n" + shared), (3, prose(3, 60)), (3, prose(3, 60)),
        (4, None), (5, ""), (6, " \t\n "), (None, prose(7, 90)), (None, None), (8, prose(8, 6000)), (9, "one two"),
        (10, prose(3, 60)), (11, prose(8, 6000).replace("katen", "other", 3)), (12, "w" * 20000), (13, "é " * 400),
        (3, prose(13, 70)), (14, shared), (-5, prose(14, 200)), (2**40 + 7, prose(15, 100)),
    ]
    rows = []
    for i, (doc_id, text) in enumerate(texts):
        lang, source = (None, None) if i % 3 == 0 else ("en", "src0")
        rows.append((doc_id, text, lang, source, None if i % 2 else 5, None, "x", None, "n", "r", 7, None, "c", 1, None, "h"))
    return rows
