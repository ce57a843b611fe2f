"""Small tables with everything that may go wrong in them, and plain versions of shared steps."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def split(text):
    return WORD.findall(text or "")


def sentence(seed, n):
    """``n`` invented words, different ones for every seed."""
    return " ".join(f"w{seed}x{(k * 7919 + seed * 104729) % 9973}" for k in range(n))


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


def doc(doc_id, text, source="s", lang="en"):
    return (doc_id, text, lang, source, None if text is None else len(text))


def awkward():
    """Nulls, empty, long, equal and repeated texts."""
    long_ = sentence(1, 30_000)
    same = sentence(2, 80)
    return [
        doc(1, None),
        doc(2, ""),
        doc(3, " \n\t "),
        doc(4, long_, None),
        doc(5, same),
        doc(6, same),
        doc(6, same),
        doc(None, same),
        doc(None, None, None),
        doc(8, "É ñ | $$$ Zürich\x1f\n\nA\nA\n b", "ü"),
        doc(9, sentence(3, 3)),
        doc(10, "THE SAME LINE\nTHE SAME LINE\n" * 30),
    ]
