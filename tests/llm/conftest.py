import random

import pytest

SYLLABLES = "an bo ce di ek fu ga hi jo ka le mu no pi ra so tu ve wa xi".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n):
    return ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(n)]


def odd_texts(seed=3):
    """Ids and texts: copies, near copies, shared passages, nulls, empty and long texts, ties."""
    rng = random.Random(seed)
    base = words(rng, 120)
    passage = " ".join(words(rng, 40))
    rows = [(number, " ".join(words(rng, rng.randint(1, 200)))) for number in range(100, 130)]
    for number in range(130, 150):
        near = list(base)
        for at in rng.sample(range(120), rng.randint(0, 4)):
            near[at] = "zz"
        rows.append((number, " ".join(near)))
    for number in range(150, 165):
        rows.append((number, " ".join([*words(rng, 30), passage, *words(rng, 30)])))
    rows += [(number, "one two three") for number in (3, 7, 170)]
    rows += [(171, "ONE  two\tthree\n"), (172, "  \n\t "), (173, ""), (174, None), (None, " ".join(base)), (None, None)]
    rows += [(175, "a" * 5000), (176, "a" * 4000), (177, "é" * 700 + passage), (178, "€" * 700 + passage)]
    rows += [(179, " ".join(words(rng, 30_000))), (180, "x" * 60 + "\U0001f600" * 30)]
    rows += [(150, rows[40][1]), (100, rows[0][1])]  # ids that come twice
    return rows


@pytest.fixture(scope="session")
def odd_rows():
    sources = ["b", "a", None, "ä", "c", "a", "a"]
    return [
        (number, text, "en", sources[at % 7], None if text is None else len(text))
        for at, (number, text) in enumerate(odd_texts())
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """A table of odd documents, with extra columns named like results and like working columns."""
    clashing = ["score", "ids", "id", "block", "node", "copies", "size", "hashes", "row", "component_id", "_copy"]
    rows = [(*row, *range(len(clashing))) for row in odd_rows]
    schema = SCHEMA + "".join(f", {name} int" for name in clashing)
    return spark.createDataFrame(rows, schema).repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
