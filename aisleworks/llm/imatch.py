"""I-Match fingerprints: hashes of a text's mid-frequency terms over randomised lexicons.

Terms are words hashed to 2 ** ``SLOT_BITS`` lexicon slots.  A slot is in the band if the share of documents that hold it lies
between ``RARE`` and ``COMMON``, that is, if its inverse document frequency lies between log(1 / COMMON) and
log(1 / RARE).  Words that share a slot by chance add about (distinct words of a text) / 2 ** SLOT_BITS to its share,
well below ``RARE`` however large the vocabulary grows; and the band is one bit per slot, however large the corpus.

Each randomised lexicon keeps its own share of the terms, and the sorted distinct terms that a text has of it are hashed.  A
lexicon that holds none of the changed terms gives an edited text the hash of the original.  So that long and short texts
both have lexicons that hold about one of their terms, lexicons come in levels of ``LEXICONS``, each level half as
dense as the one before, and a fingerprint has the two levels that fit its number of terms.

All of it is DataFrame code.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aisleworks.llm.shared import only, stored

SLOT_BITS = 20
RARE, COMMON = 0.001, 0.02
LEXICON_BITS = 5
LEXICONS = 1 << LEXICON_BITS
#: Ranges of doc_id in which neighbours are found, at most.
RANGES = 1024

_SEPARATORS = r"[^\p{L}\p{N}]+"
_LOWEST = -(2**63)
_NONE = 0


def _terms(text: Column) -> Column:
    """Distinct 64-bit hashes of a text's lower-case words; the low bits of a hash are its slot."""
    words = F.array_distinct(F.split(F.lower(text), _SEPARATORS))
    return F.transform(F.array_remove(words, ""), lambda word: F.xxhash64(word))


def _slot(term: Column) -> Column:
    return term.bitwiseAND(F.lit((1 << SLOT_BITS) - 1))


def band(docs: DataFrame) -> list[int]:
    """Bits of the slots in the band, 64 to a number: 2 ** SLOT_BITS / 64 numbers for any corpus.

    Counts cover every document of ``docs`` (text) that has a word.
    """
    slots = docs.select(F.array_distinct(F.transform(_terms(F.col("text")), _slot)).alias("slots")).filter(F.size("slots") > 0)
    # Slot -1 counts the documents.
    held = stored(
        slots.select(F.explode(F.array_append("slots", F.lit(-1).cast("long"))).alias("slot"))
        .groupBy("slot").agg(F.count(F.lit(1)).alias("held")),
        "slots",
    )
    total = held.filter("slot = -1").select("held").first()
    words = [0] * ((1 << SLOT_BITS) // 64)
    if total is None:
        return words
    bits = (
        held.filter((F.col("slot") >= 0) & F.col("held").between(RARE * total[0], COMMON * total[0]))
        .groupBy(F.shiftright("slot", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("bits"))
    )
    for row in bits.collect():  # at most 2 ** SLOT_BITS / 64 rows
        words[row["word"]] = row["bits"]
    return words


def _numbers(values: list[int]) -> Column:
    """Numbers as a constant array: one literal to Spark, where F.lit would make an expression of each."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def fingerprint(text: Column, bits: list[int]) -> Column:
    """Struct (level, dense, sparse): the texts's level and the hashes of its level's and the next one's lexicons.

    A text without a term in the band uses all its terms; without words every hash is 0, which
    stands for a lexicon that holds none of the text's terms.
    """
    band_bits = _numbers(bits)

    def in_band(term: Column) -> Column:
        word = F.element_at(band_bits, (F.shiftright(_slot(term), 6) + 1).cast("int"))
        return F.getbit(word, F.pmod(term, F.lit(64)).cast("int")) == 1

    def prepared(every: Column) -> Column:
        inside = F.filter(every, in_band)
        return F.sort_array(F.when(F.size(inside) > 0, inside).otherwise(every))

    def levelled(terms: Column) -> Column:
        level = F.greatest(F.lit(0), F.ceil(F.log2(F.size(terms) / F.lit(float(LEXICONS))))).cast("int")
        return F.struct(level.alias("level"), terms.alias("terms"))

    def thinned(found: Column, more: int) -> Column:
        mask = F.call_function("shiftleft", F.lit(1), found["level"] + more) - 1
        return F.filter(found["terms"], lambda t: F.shiftright(t, 40 + LEXICON_BITS).bitwiseAND(mask.cast("long")) == 0)

    def hashed(terms: Column) -> Column:
        def lexicon(number: Column) -> Column:
            own = F.filter(terms, lambda t: F.shiftright(t, 40).bitwiseAND(F.lit(LEXICONS - 1)) == number)
            return F.when(F.size(own) > 0, F.xxhash64(own)).otherwise(F.lit(_NONE).cast("long"))

        return F.transform(F.sequence(F.lit(0), F.lit(LEXICONS - 1)), lexicon)

    # Each step is bound as the one element of an array, so that it is worked out once.
    def bind(value: Column, use) -> Column:
        return F.element_at(F.transform(F.array(value), use), 1)

    return bind(
        bind(bind(_terms(text), prepared), levelled),
        lambda found: F.struct(
            found["level"].alias("level"),
            bind(thinned(found, 0), hashed).alias("dense"),
            bind(thinned(found, 1), hashed).alias("sparse"),
        ),
    )


def as_text(found: Column) -> Column:
    """``level:hash,hash,...``, each hash as eight hexadecimal digits and empty for a lexicon without terms."""
    shown = F.transform(
        F.concat(found["dense"], found["sparse"]),
        lambda h: F.when(h == _NONE, "").otherwise(F.lpad(F.lower(F.hex(h.bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")),
    )
    return F.concat_ws(":", found["level"].cast("string"), F.array_join(shown, ","))


def likeness(one: Column, two: Column) -> Column:
    """Share of equal hashes among the lexicons that hold a term of either text, on the levels both have.

    Texts whose numbers of terms differ more than fourfold share no level and are unlike (0); equal
    fingerprints are 1, those of two empty texts too.
    """
    step = one["level"] - two["level"]
    left = F.when(step == 0, F.concat(one["dense"], one["sparse"])).when(step == 1, one["dense"]).when(step == -1, one["sparse"])
    right = F.when(step == 0, F.concat(two["dense"], two["sparse"])).when(step == 1, two["sparse"]).when(step == -1, two["dense"])
    # 2: equal, 1: held by either text only, 0: by neither.
    marks = F.zip_with(
        left, right, lambda a, b: F.when((a == _NONE) & (b == _NONE), 0).when(a == b, 2).otherwise(1)
    )
    counts = F.aggregate(
        marks, F.struct(F.lit(0).alias("same"), F.lit(0).alias("held")),
        lambda s, m: F.struct(
            (s["same"] + F.when(m == 2, 1).otherwise(0)).alias("same"),
            (s["held"] + F.when(m > 0, 1).otherwise(0)).alias("held"),
        ),
        lambda s: F.when(s["held"] > 0, s["same"] / s["held"]),
    )
    return F.when(one == two, 1.0).otherwise(F.coalesce(counts, F.lit(0.0)))


def with_next(rows: DataFrame, derive: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``derive(rows)`` with next, a struct of the same columns of the next row: descending doc_id, then text; last wraps to first.

    ``rows`` has doc_id and text.  No task sees all rows: ranges of doc_id, cut at its quantiles, are ordered each for
    itself, and the last row of a range takes its next from the few first rows of ranges.  Rows without doc_id
    come last.
    """
    key = F.coalesce("doc_id", F.lit(_LOWEST))
    ranges = max(2, min(RANGES, 2 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    cuts = rows.agg(F.percentile_approx(key, [i / ranges for i in range(1, ranges)], 10 * RANGES).alias("cuts")).first()
    bounds = sorted(set(cuts["cuts"] or [0]))
    ranged = rows.withColumn("key", key).withColumn(
        "range", F.size(F.filter(_numbers(bounds), lambda bound: bound < F.col("key")))
    )
    heads = ranged.groupBy("range").agg(F.max("key").alias("key"))
    firsts = derive(
        ranged.join(F.broadcast(heads), ["range", "key"])  # at most RANGES rows
        .groupBy("range").agg(F.min_by("doc_id", "text").alias("doc_id"), F.min("text").alias("text"))
    )
    columns = [c for c in firsts.columns if c != "range"]
    lower = Window.orderBy(F.col("range").desc())  # over at most RANGES rows
    after = firsts.select("range", F.struct(*columns).alias("first")).select(
        "range",
        F.coalesce(F.lead("first").over(lower), F.max_by("first", "range").over(Window.partitionBy())).alias("after"),
    )
    inside = Window.partitionBy("range").orderBy(F.col("key").desc(), "text")
    led = derive(ranged).withColumn("inside", F.lead(F.struct(*columns)).over(inside))
    return led.join(after, "range").select(*columns, F.coalesce("inside", "after").alias("next"))


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row of ``docs``.

    The edited text has its last floor(n_chars / 3) code points replaced by as many, or all, of the next
    document's first.  near_edited and near_next are the likeness of a row's fingerprint to those of its edited
    text and of the next document.  NULL texts are empty; an only row is its own next; repeated rows follow
    each other; other columns are ignored; an empty table gives an empty result.
    """
    rows = only(docs, doc_id="long", text="string").withColumn("text", F.coalesce("text", F.lit("")))
    bits = band(rows)
    size = F.length("text")
    part = F.floor(size / 3).cast("int")
    edited = with_next(rows, lambda some: some.withColumn("own", fingerprint(F.col("text"), bits))).select(
        "doc_id", size.cast("long").alias("n_chars"), "own", F.col("next.own").alias("next_own"),
        F.concat(F.left("text", size - part), F.left("next.text", part)).alias("edited"),
    )
    found = edited.withColumn("edited_own", fingerprint(F.col("edited"), bits))
    return found.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("own")).alias("fingerprint"), as_text(F.col("edited_own")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("edited_own")).alias("near_edited"),
        likeness(F.col("own"), F.col("next_own")).alias("near_next"),
    )
