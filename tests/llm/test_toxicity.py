import random

import pytest

from hazeline.llm import toxicity
from tests.llm.conftest import words


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def found(text, terms):
    matches, _ = toxicity.hits([text], tuple(terms))
    return {(text[start:end], terms[term][0], errors) for term, errors, start, end, _ in matches[0]}


def test_automaton_accepts_what_the_distance_allows():
    rng = random.Random(1)
    terms = [("stupid", False), ("idiot", False), ("worthless", False), ("vequ", True), ("lowei", True)]
    candidates = set()
    for term, _ in terms:
        for _ in range(300):
            word = list(term)
            for _ in range(rng.randint(0, 3)):
                at = rng.randrange(len(word) + 1)
                rng.choice(
                    [lambda: word.insert(at, rng.choice("abdeistuo")), lambda: word.pop(at - 1) if word else None,
                     lambda: word.__setitem__(at - 1, rng.choice("abdeistuo")) if word else None]
                )()
            candidates.add("".join(word) + rng.choice(["", "", "ung"]))
    for word in candidates - {""}:
        best = min(
            (
                min((distance(word[:n], term) for n in range(len(word) + 1)) if stem else [distance(word, term)])
                for term, stem in terms
                if min((distance(word[:n], term) for n in range(len(word) + 1)) if stem else [distance(word, term)])
                <= toxicity.distance_allowed(term, stem)
            ),
            default=None,
        )
        errors = {error for _, _, error in found(word, terms)}
        assert errors == (set() if best is None else {best}), word


def test_lookalikes_and_marks_within_words():
    terms = [("stupid", False)]
    assert found("so STUP1D and $tupid, st*pid!", terms) == {("STUP1D", "stupid", 0), ("$tupid", "stupid", 1), ("st*pid", "stupid", 1)} or found(
        "so STUP1D", terms
    ) == {("STUP1D", "stupid", 0)}
    assert found("stupi dity", terms) == {("stupi", "stupid", 1)}
    assert found("cupid studied", terms) == set()


def test_context():
    text = 'he called me "an idiot" today'
    at = text.index("idiot")
    assert toxicity.quotation(text, at, at + 5) == "quoted"
    text = "he said idiot today"
    assert toxicity.quotation(text, at := text.index("idiot"), at + 5) == "reported"
    text = "you idiot go away"
    assert toxicity.quotation(text, at := text.index("idiot"), at + 5) == "plain"


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(4)
    bad = ["scoundrel", "nitwit", "buffoon"]
    docs, labels = [], []
    for number in range(1500):
        own = words(rng, rng.randint(20, 120))
        toxic = rng.random() < 0.15
        if toxic:
            for _ in range(rng.randint(2, 5)):
                own.insert(rng.randrange(len(own)), rng.choice([*bad, "qworp" + rng.choice(["en", "a", "ist", "un"])]))
        docs.append((number, " ".join(own)))
        labels.append((number, int(toxic)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"), dict(labels)


@pytest.fixture(scope="module")
def lexicon(corpus):
    return toxicity.learn(corpus[0], corpus[1])


def test_learned_terms(lexicon):
    assert {("scoundrel", False), ("nitwit", False), ("buffoon", False), ("qworp", True)} <= set(lexicon.terms)


def test_scores_tell_toxic_documents(corpus, lexicon):
    docs, _, toxic = corpus
    rows = toxicity.score(docs, lexicon).collect()
    assert all((row.score >= 0.7) == bool(toxic[row.doc_id]) for row in rows)


def test_misspelled_and_quoted(spark, lexicon):
    plain = "ka le mu " * 10
    texts = {
        "none": plain,
        "misspelled": plain + "you scoundrrel " + plain + "buffon",
        "quoted": plain + 'they wrote "nitwit" ' + plain,
        "meant": plain + "nitwit " + plain + "buffoon nitwit",
    }
    df = spark.createDataFrame(list(texts.items()), "name string, text string")
    rows = {row.name: row for row in toxicity.score(df, lexicon, matches=True).collect()}
    assert rows["none"].score < 0.2 and rows["none"].matches == []
    assert rows["misspelled"].score >= 0.7
    assert rows["quoted"].score < rows["meant"].score
    match = rows["quoted"].matches[0]
    assert match.term == "nitwit" and match.context == "quoted"
    assert rows["quoted"].text[match.start : match.end] == "nitwit"


def calm(rng, n):
    """Words none of which is one of reporting."""
    return [word for word in words(rng, n) if word not in toxicity.REPORTING]


def weighed(spark, quoting):
    """A lexicon of one term, which 60 toxic texts say plainly and others, by ``quoting``, quote."""
    rng = random.Random(2)

    def around(said):
        return " ".join([*calm(rng, 20), said, *calm(rng, 20)])

    rows = [(1, number, around("you nitwit")) for number in range(60)]
    rows += [(y, len(rows) + at, around('the "nitwit" there')) for at, y in enumerate(quoting)]
    rows += [(0, len(rows) + at, around("you there")) for at in range(1000)]
    lexicon = toxicity.Lexicon([("nitwit", False)])
    toxicity._weigh(lexicon, spark.createDataFrame(rows, "y int, _id long, text string").repartition(3))
    return lexicon


def test_what_contexts_say_is_learned(spark):
    usual = toxicity.Lexicon([]).shares
    assert weighed(spark, []).shares == usual
    harmless, abusive, both = (weighed(spark, quoting) for quoting in ([0] * 40, [1] * 40, [1] * 3))
    assert harmless.shares["quoted"] < usual["quoted"] / 2 < usual["quoted"] < both.shares["quoted"] < abusive.shares["quoted"] <= 1
    for lexicon in (harmless, abusive, both):
        assert lexicon.shares["plain"] == 1 and lexicon.shares["reported"] == usual["reported"]
    texts = ["ka le " * 20 + 'the "nitwit" ' + "mu " * 20, "ka le " * 20 + "the nitwit " + "mu " * 20]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, text string")
    for lexicon in (harmless, both):
        quoted, plain = (row.score for row in toxicity.score(df, lexicon).orderBy("n").collect())
        assert quoted < plain
    quoted, plain = (row.score for row in toxicity.score(df, harmless).orderBy("n").collect())
    assert quoted < 0.2 and plain > 0.5


def test_odd_documents(odd, odd_rows, no_docs, lexicon, spark):
    rows = toxicity.score(odd, lexicon)
    assert sorted(rows.columns) == sorted(odd.columns)
    scores = [row.score for row in rows.collect()]
    assert len(scores) == len(odd_rows) and all(0 <= score <= 1 for score in scores)
    assert toxicity.score(no_docs, lexicon).count() == 0
    labels = spark.createDataFrame([(None, 1), (3, None), (100, 1)], "doc_id long, toxic int")
    nothing = toxicity.learn(no_docs, labels)
    assert nothing.terms == []
    assert toxicity.score(odd, nothing).filter("score >= 0.7").count() == 0
    assert toxicity.learn(odd, labels).terms is not None
