import math
import re
from collections import Counter

from hazeline.llm import backoff

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(texts, order=3, alpha=0.4):
    """Words, and the score by the counts of other texts and by those of all."""
    own = [re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)) for text in texts]
    grams = [Counter(tuple(w[at : at + n]) for n in range(order + 1) for at in range(len(w) - n + 1 if n else len(w))) for w in own]
    total = Counter()
    for count in grams:
        total.update(count)
    out = []
    for words, mine in zip(own, grams, strict=True):
        score = corpus = 0
        for at in range(len(words)):
            longest = min(order, at + 1)
            gram = tuple(words[at + 1 - longest : at + 1])
            corpus += round(math.log(total[gram] / total[gram[:-1]]) * 1e6)
            for n in range(longest, 0, -1):
                gram = tuple(words[at - n + 1 : at + 1])
                count = total[gram] - mine[gram]
                if n == 1:
                    count = max(1, count)
                if count:
                    ratio = count / max(1, total[gram[:-1]] - mine[gram[:-1]])
                    score += round(math.log(ratio * alpha ** (longest - n)) * 1e6)
                    break
        out.append((len(words), score, corpus))
    return out


def key(row):
    return tuple((value is None, value) for value in row)


def test_odd_documents(odd, odd_rows):
    expected = [(row[0], *own) for row, own in zip(odd_rows, brute([row[1] for row in odd_rows]), strict=True)]
    found = sorted(map(tuple, backoff.score(odd).collect()), key=key)
    for one, other in zip(found, sorted(expected, key=key), strict=True):
        assert one[:2] == other[:2]
        assert all(abs(a - b) <= 2 + abs(b) * 1e-9 for a, b in zip(one[2:], other[2:]))


def test_other_orders(spark):
    texts = ["a b c a b d", "a b c", "c a b", "", "x"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for order in (1, 2, 4):
        found = sorted(map(tuple, backoff.score(df, order=order).collect()))
        assert [row[1:] for row in found] == brute(texts, order)


def test_no_rows(no_docs):
    assert backoff.score(no_docs).count() == 0


def test_texts_are_dealt_once_and_compressed(spark, plan):
    found = backoff.score(spark.createDataFrame([(1, "a b c"), (2, "b c")], "doc_id long, text string"))
    found.collect()
    text = plan(found)
    moved = re.findall(r"\) Exchange\nInput \[\d+\]: (.*)", text)
    assert moved and not any("text#" in columns for columns in moved)
    assert "ReusedExchange" in text
