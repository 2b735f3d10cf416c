"""Document fingerprints: I-Match over several randomised lexicons, in Spark's own functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazeline.llm.tables import partitions, power_of_two, stored, unused

#: Terms are split at ASCII characters that are neither letters nor digits.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Lexicon terms are in at least and at most these shares of all documents.
RAREST, COMMONEST = 0.002, 0.2
#: Randomised lexicons, a power of two: each term is in one.
LEXICONS = 32
#: Terms of the lexicon are marked in a table of bits by their hash: 64 for each, and as many as this at least.
LEAST_BITS = 1 << 19


def all_terms(text: Column) -> Column:
    """Hashes of the distinct terms of a text, in lower case."""
    parts = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), BETWEEN), lambda t: t != "")
    return F.array_distinct(F.transform(parts, lambda t: F.xxhash64(t)))


def _word(term: Column, words: Column) -> Column:
    """The place of a term's bit in a table of so many words of 64 bits, a power of two."""
    return F.shiftrightunsigned(term, 6).bitwiseAND(words - 1)


def lexicon(docs: DataFrame, text_col: str = "text", rarest: float = RAREST, commonest: float = COMMONEST) -> DataFrame:
    """One row ``bits``: the terms within the band of document frequency, over all documents.

    Terms are counted with partial sums, one row per term and task at most. Terms in at least a
    share ``rarest`` of the documents are never more than the mean number of terms per document
    divided by that share, however many documents there are, and so are the words of 64 bits, or about. Another
    term is taken for one in the lexicon if it shares its bit, one in 64 or fewer, in all documents alike.
    """
    frequencies = docs.select(F.explode(all_terms(F.col(text_col))).alias("term")).groupBy("term").count()
    total = docs.select(F.count(F.lit(1)).alias("n"))
    n = total.scalar()
    inside = frequencies.filter((F.col("count") >= F.lit(rarest) * n) & (F.col("count") <= F.lit(commonest) * n))
    inside = stored(inside.select("term"), "lexicon-terms")
    size = max(LEAST_BITS // 64, 1 << power_of_two(inside.count()))
    marked = inside.select(
        _word(F.col("term"), F.lit(size).cast("long")).alias("word"),
        F.expr("shiftleft(1L, CAST(term & 63 AS INT))").alias("bit"),
    ).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    words = docs.sparkSession.range(size).withColumnRenamed("id", "word")
    return (
        words.join(marked, "word", "left")
        .select(F.struct("word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits")).alias("entry"))
        .agg(F.sort_array(F.collect_list("entry")).alias("entries"))
        .select(F.col("entries.bits").alias("bits"))
    )


def with_signatures(df: DataFrame, text_col: str, bits: DataFrame, name: str) -> DataFrame:
    """Add ``name``: one hash per randomised lexicon, null where the text has no term of it.

    A text's terms are those in the lexicon; if it has none, all its terms; without any term, the
    text itself counts as one. Each randomised lexicon is nested: half of its terms, a quarter
    and so on. The smallest that still has terms of the text counts, and its hash is that of the
    terms it keeps, sorted. So a text changed in part keeps the hashes whose few terms stayed.

    ``bits`` is the one row of ``lexicon``, of a fixed size, and goes to every task. Steps are
    columns of their own, so that each is computed once.
    """
    # The low bits of a hash say whether it is in the lexicon, those from 19 on in which randomised one,
    # those from bit 24 on how small a part of that still holds it.
    _bits, _found, _marked, _terms = (unused(own, df.columns) for own in ("_bits", "_found", "_marked", "_terms"))
    table = F.col(_bits)
    marked = F.filter(
        _found,
        lambda t: F.getbit(
            F.element_at(table, (_word(t, F.size(table).cast("long")) + 1).cast("int")), t.bitwiseAND(63).cast("int")
        ) == 1,
    )
    terms = (
        F.when(F.size(_marked) > 0, F.col(_marked))
        .when(F.size(_found) > 0, F.col(_found))
        .otherwise(F.array(F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))))
    )

    def place(t: Column) -> Column:
        return F.shiftrightunsigned(t, 24)

    own = F.transform(
        F.sequence(F.lit(0), F.lit(LEXICONS - 1)),
        lambda n: F.filter(_terms, lambda t: F.shiftrightunsigned(t, 19).bitwiseAND(LEXICONS - 1) == n),
    )
    nested = F.transform(
        own,
        lambda terms: F.struct(
            terms.alias("terms"),
            F.pow(F.lit(2.0), F.floor(F.log2(F.array_min(F.transform(terms, place)) + 1)) + 1).alias("part"),
        ),
    )
    hashes = F.transform(
        nested,
        lambda own: F.when(
            F.size(own["terms"]) > 0,
            F.xxhash64(F.sort_array(F.filter(own["terms"], lambda t: place(t) + 1 < own["part"]))).bitwiseAND(0xFFFFFFFF),
        ),
    )
    return (
        df.withColumn(_found, all_terms(F.col(text_col)))
        .join(F.broadcast(bits.withColumnRenamed("bits", _bits)))
        .withColumn(_marked, marked)
        .drop(_bits)
        .withColumn(_terms, terms)
        .withColumn(name, hashes)
        .drop(_found, _marked, _terms)
    )


def written(hashes: Column) -> Column:
    """The fingerprint as text: eight hexadecimal digits per randomised lexicon, or hyphens."""
    return F.array_join(
        F.transform(hashes, lambda h: F.coalesce(F.lower(F.lpad(F.hex(h), 8, "0")), F.lit("-" * 8))), ""
    )


def likeness(one: Column, other: Column) -> Column:
    """Of the randomised lexicons that either text has terms of, the share with equal hashes."""
    pairs = F.filter(F.arrays_zip(one.alias("a"), other.alias("b")), lambda p: F.coalesce(p["a"], p["b"]).isNotNull())
    same = F.filter(pairs, lambda p: p["a"] == p["b"])
    return F.when(F.size(pairs) > 0, F.size(same) / F.size(pairs)).otherwise(F.lit(1.0))


def fingerprint(docs: DataFrame, text_col: str = "text", **band) -> DataFrame:
    """Add ``hashes`` and ``fingerprint`` to the rows of ``docs``.

    Null texts count as empty. Equal texts have equal fingerprints; repeated rows are rows like
    others. An empty table has an empty lexicon and no rows. Columns with these names are
    replaced.
    """
    hashed = with_signatures(docs.drop("hashes"), text_col, lexicon(docs, text_col, **band), "hashes")
    return hashed.withColumn("fingerprint", written(F.col("hashes")))


def _below(cuts: list[int], value: Column) -> Column:
    """How many of the sorted cuts are below a value, by binary search."""
    bits = (len(cuts) + 1).bit_length()
    padded = F.array(*[F.lit(cut) for cut in cuts + [2**63 - 1] * ((1 << bits) - len(cuts))]).cast("array<bigint>")
    steps = F.array(*[F.lit(1 << bit) for bit in reversed(range(bits))])
    return F.aggregate(
        steps, F.lit(0), lambda n, step: F.when(F.element_at(padded, n + step) < value, n + step).otherwise(n)
    )


def with_next(
    docs: DataFrame, id_col: str, columns: list[str], prepare: Callable[[DataFrame], DataFrame] = lambda df: df
) -> DataFrame:
    """Add ``next_<column>`` of the next row in descending order of id; after the last, the first.

    ``prepare`` adds columns, which can be among ``columns``, to the rows and to those copied.

    Null ids come last; rows with equal ids follow a hash of their columns. The ids are cut at
    quantiles into ranges, several per task. Each range is ordered by itself, together with a
    copy of the first row of the range that follows, so nothing passes through one task.
    """
    spark = docs.sparkSession
    number = 4 * partitions(spark)
    edges = [at / number for at in range(1, number)]
    cuts = docs.agg(F.percentile_approx(F.col(id_col), edges, 20 * number).alias("cuts")).first().cuts or []
    # The number of a range counts down; rows without an id have a range of their own at the end.
    at = F.when(
        F.col(id_col).isNotNull(), F.lit(number) - _below(sorted(set(cuts)), F.col(id_col).cast("long"))
    ).otherwise(F.lit(number + 1))
    placed = docs.withColumn("_range", at)
    tie = F.xxhash64(*[F.col(c) for c in docs.columns])
    order = [F.col(id_col).desc_nulls_last(), F.col("_tie")]
    used = (
        placed.groupBy("_range")
        .agg(F.max(F.col(id_col)).alias("_first"))
        .withColumn("_before", F.lag("_range").over(Window.orderBy("_range")))
        .withColumn("_before", F.coalesce("_before", F.max("_range").over(Window.partitionBy())))
    )
    heads = (
        placed.withColumn("_tie", tie)
        .join(
            F.broadcast(used.withColumnRenamed("_range", "_r")),
            (F.col("_range") == F.col("_r")) & F.col(id_col).eqNullSafe(F.col("_first")),
        )
        .withColumn("_n", F.row_number().over(Window.partitionBy("_range").orderBy("_tie")))
        .filter("_n = 1")
        .withColumn("_range", F.col("_before"))
        .withColumn("_copy", F.lit(1))
        .drop("_r", "_first", "_before", "_n")
    )
    rows = prepare(placed.withColumn("_tie", tie).withColumn("_copy", F.lit(0)).unionByName(heads))
    in_range = Window.partitionBy("_range").orderBy("_copy", *order)
    return (
        rows.withColumn("_next", F.lead(F.struct(*columns)).over(in_range))
        .filter("_copy = 0")
        .drop("_range", "_tie", "_copy")
        .select("*", *[F.col("_next")[c].alias(f"next_{c}") for c in columns])
        .drop("_next")
    )


def edits(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **band) -> DataFrame:
    """Fingerprints of each text, of an edited copy, and how alike they are.

    In the copy the last third of the code points, rounded down, is replaced by as many from the
    start of the next document in descending order of id (or by all of it). Gives ``id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``. Null texts count as
    empty; a single row is its own next.
    """
    texts = docs.select(F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    bits = stored(lexicon(texts, **band), "lexicon")
    length = F.char_length("text")
    third = F.floor(length / 3).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), length - third),
        F.substring(F.col("next_text"), F.lit(1), third),
    )
    paired = with_signatures(
        with_next(
            texts, id_col, ["text", "hashes"], lambda df: with_signatures(df, "text", bits, "hashes")
        ).withColumn("edited", edited),
        "edited", bits, "edited_hashes",
    )
    return paired.select(
        id_col,
        length.cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        written(F.col("hashes")).alias("fingerprint"),
        written(F.col("edited_hashes")).alias("edited_fingerprint"),
        likeness(F.col("hashes"), F.col("edited_hashes")).alias("near_edited"),
        likeness(F.col("hashes"), F.col("next_hashes")).alias("near_next"),
    )
