import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SOUNDS = {"en": "the of and ing tion er at re on th".split(), "de": "der und ung keit sch ein ver zu ge ich".split(), "fr": "le de et eau eux que ment tion ou ré".split(), "es": "el la que ción os ar ado mente ez ñ".split()}


def prose(rng, lang, n):
    return " ".join("".join(rng.choice(SOUNDS[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n)) + "."


def changed(rng, text, share):
    return " ".join("x" + w if rng.random() < share else w for w in text.split(" "))


@pytest.fixture(scope="session")
def rows():
    """Prose in four languages with exact and near copies, empty and null cells, repeated rows and a very long text."""
    rng, out = random.Random(1), []
    for i in range(160):
        lang = rng.choice(list(SOUNDS))
        out.append((i, prose(rng, lang, rng.randint(5, 120)), lang, f"s{rng.randrange(3)}", 0))
    for i in range(160, 200):
        out.append((i, changed(rng, out[i % 13][1], rng.choice([0, 0.02, 0.05, 0.1, 0.2])), out[i % 13][2], "s0", 0))
    out += [(200, None, "en", "s1", None), (201, "", None, None, 0), (202, " \t\n ", "de", None, 4), (203, "one", None, "s1", 3), (204, "ONE", None, "s1", 3), (None, "no id at all here", None, None, None), (205, "1234 !!", "fr", "s2", 7), (206, prose(rng, "en", 30_000), "en", "s2", None)]
    return out + [out[3], out[3]]


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)
