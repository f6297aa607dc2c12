"""Distribution divergence: documents against the character and word habits of their language.

References are sums over all documents of a language: characters by class and occurrences of its most
frequent words. A document is compared with the reference of its own language by Jensen-Shannon distance, once over
the classes and once over the frequent words (all other words are one entry). Short texts scatter too much, so each
comparison only counts from a minimum length on. Everything is DataFrame functions; the words of a text are
handled inside its row, so no text is shuffled. ``judge`` reads the texts twice: words are counted first, then
every row is measured, and the class references are summed over the slim rows.

A word of a text is known by its 64-bit hash after it is cut: windows and frequent words compare integers. Two
different words share a hash with a chance of 2**-64.

Defined results: null and empty texts have no words and fail the base rule; documents without a language are
compared with the sum over all documents, as are those of a language with fewer than ``min_reference`` words;
repeated rows get equal results; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuswright.llm.common import let, words_of
from corpuswright.session import cut_lineage

SYMBOLS = "#*$%&|<>"
CLASSES = ["lower", "upper", "digits", "blanks", "symbols", "marks"]
ALL = ""  # key of the reference over all documents; a language's key starts with a letter l


def _length_without(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, pattern, ""))


def char_classes(text: Column) -> Column:
    """Struct of counts by class; ``marks`` is whatever is no letter, digit, blank or symbol."""

    def counts(rest: Column) -> Column:
        n, upper = F.length(text), F.length(F.regexp_replace(text, r"\P{Lu}+", ""))
        blanks = F.length(rest) - _length_without(rest, r"[\x20\x09-\x0D]+")
        digits = F.length(rest) - _length_without(rest, r"[0-9]+")
        symbols = F.length(rest) - F.length(F.translate(rest, SYMBOLS, ""))
        letters = n - F.length(rest)
        found = [letters - upper, upper, digits, blanks, symbols, F.length(rest) - blanks - digits - symbols]
        return F.struct(*[c.cast("long").alias(name) for c, name in zip(found, CLASSES, strict=True)])

    return let(F.regexp_replace(text, r"\p{L}+", ""), counts)


def repeated_words(hashes: Column) -> Column:
    """Words inside three-word windows that occur at least twice in the text, from the words' hashes.

    A window becomes one integer: the high bits of its hash, then its position in as many bits as the text
    needs, so one sort of integers brings equal windows together. Two different windows of a text of n words share
    the hash bits with a chance of about n**3 / 2**65.
    """

    def windows(w: Column) -> Column:
        n = F.size(w)
        bits = F.length(F.bin(n))
        shift = lambda x: F.call_function("shiftleft", x, bits)
        top = lambda x: F.call_function("shiftright", x, bits)
        packed = F.transform(F.slice(w, F.lit(1), n - 2), lambda x, i: shift(F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))) + i)

        def twice(s: Column) -> Column:
            same = lambda x, i: F.coalesce(top(x) == top(F.get(s, i)), F.lit(False))
            starts = F.filter(s, lambda x, i: same(x, i - 1) | same(x, i + 1))
            return F.sort_array(F.transform(starts, lambda x: x.bitwiseAND(shift(F.lit(1).cast("long")) - 1)))

        def covered(at: Column) -> Column:
            steps = F.transform(at, lambda x, i: F.least(F.lit(3).cast("long"), F.coalesce(F.get(at, i + 1) - x, F.lit(3).cast("long"))))
            return F.aggregate(steps, F.lit(0).cast("long"), lambda a, b: a + b)

        return F.when(n >= 3, let(let(F.sort_array(packed), twice), covered)).otherwise(F.lit(0).cast("long"))

    return let(hashes, windows)


def duplicate_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def language_key(lang: Column) -> Column:
    return F.when(lang.isNull(), F.lit(ALL)).otherwise(F.concat(F.lit("l"), lang.cast("string")))


def _with_all(df: DataFrame, group: list[str], sums: list[str]) -> DataFrame:
    """Rows by language and their sum over all."""
    own = df.where(F.col("key") != ALL)
    return own.unionByName(df.groupBy(*[F.lit(ALL).alias("key"), *group]).agg(*[F.sum(c).alias(c) for c in sums]))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), language_key(F.col("lang")).alias("key"))


def _share(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def word_references(docs: DataFrame, *, common_words: int = 40, min_reference: int = 2000) -> DataFrame:
    """One row per language and one over all: key, n (words), words, word_shares, and the places of the words' hashes.

    Words are counted over all documents with map-side combine; only each language's ``common_words`` most
    frequent ones (ties by word) are kept. Their hashes are put into ``slots`` of a small table: ``shift`` is the first
    number of bits by which the hashes, shifted right, fall into different slots (null if there is none).
    """
    words = _keyed(docs).select("key", F.explode(words_of(F.col("text"))).alias("word"))
    counts = cut_lineage(words.groupBy("key", "word").agg(F.count(F.lit(1)).alias("n")))
    every = _with_all(counts, ["word"], ["n"])
    # a reference over all documents exists even where they have no word
    none = docs.sparkSession.range(1).select(F.lit(ALL).alias("key"), F.lit(0).cast("long").alias("n"))
    sums = _with_all(counts.select("key", "n"), [], ["n"]).unionByName(none).groupBy("key").agg(F.sum("n").alias("n"))
    sums = sums.where(F.col("n") >= F.when(F.col("key") == ALL, F.lit(0)).otherwise(F.lit(min_reference)))

    # the least count among the most frequent words, found on the few different counts, trims the words first
    limit = every.groupBy("key", "n").agg(F.count(F.lit(1)).alias("words"))
    reached = F.sum("words").over(Window.partitionBy("key").orderBy(F.desc("n"))) - F.col("words")
    least = limit.withColumn("before", reached).where(F.col("before") < common_words).groupBy("key").agg(F.min("n").alias("least"))
    near = every.join(cut_lineage(least), "key").where("n >= least")
    rank = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("n"), "word"))
    top = near.withColumn("rank", rank).where(F.col("rank") <= common_words).groupBy("key").agg(F.sort_array(F.collect_list(F.struct("rank", "word", "n"))).alias("top"))

    bits = max(6, (common_words**2).bit_length())
    slot = lambda h, s: _slot(h, s, bits)
    shifts = F.filter(F.sequence(F.lit(0), F.lit(64 - bits)), lambda s: F.size(F.array_distinct(F.transform("hashes", lambda h: slot(h, s)))) == F.size("hashes"))
    every_slot = F.sequence(F.lit(0), F.lit((1 << bits) - 1))
    found = (
        sums.join(top, "key", "left")
        .withColumn("words", F.coalesce(F.transform("top", lambda x: x["word"]), F.array().cast("array<string>")))
        .withColumn("shares", F.coalesce(F.transform("top", lambda x: _share(x["n"], F.col("n"))), F.array().cast("array<double>")))
        .withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
        .withColumn("shift", F.array_min(shifts))
        .withColumn("taken", F.transform("hashes", lambda h: slot(h, F.col("shift"))))
        .withColumn("places", F.transform(every_slot, lambda i: F.array_position("taken", i).cast("int")))
        .withColumn("slots", F.transform("places", lambda k: F.when(k > 0, F.get("hashes", k - 1))))
    )
    return cut_lineage(found.select("key", "n", "words", "shares", "hashes", "shift", "slots", "places"))


def _slot(h: Column, shift: Column, bits: int) -> Column:
    return F.call_function("shiftrightunsigned", h, shift).bitwiseAND(F.lit((1 << bits) - 1)).cast("int")


def class_references(counted: DataFrame, *, min_reference: int = 2000) -> DataFrame:
    """key and classes (shares of the characters) of each language and of all, from rows with ``lang_key``, ``n_words`` and ``c``."""
    totals = counted.groupBy(F.col("lang_key").alias("key")).agg(F.sum("n_words").alias("n"), *[F.sum(f"c.{c}").alias(c) for c in CLASSES])
    sums = _with_all(totals, [], ["n", *CLASSES]).where((F.col("key") == ALL) | (F.col("n") >= min_reference))
    chars = sum((F.col(c) for c in CLASSES[1:]), F.col(CLASSES[0]))
    return cut_lineage(sums.select("key", F.array(*[_share(F.col(c), chars) for c in CLASSES]).alias("classes")))


def references(docs: DataFrame, *, common_words: int = 40, min_reference: int = 2000) -> DataFrame:
    """References of a corpus to judge other documents by: ``word_references`` with the classes of each key."""
    words = word_references(docs, common_words=common_words, min_reference=min_reference)
    rows = _keyed(docs).select(F.col("key").alias("lang_key"), char_classes(F.col("text")).alias("c"), F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("n_words"))
    return words.join(class_references(rows, min_reference=min_reference), "key")


def _term(p: Column, q: Column) -> Column:
    """Twice one entry's part of the Jensen-Shannon divergence, in nats."""
    part = lambda x: F.when(x > 0, x * F.log(2 * x / (p + q))).otherwise(F.lit(0.0))
    return part(p) + part(q)


def _distance(parts: Column) -> Column:
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(parts, F.lit(0.0), lambda a, b: a + b) / F.lit(2 * 0.6931471805599453)))


def class_distance(found: Column, classes: Column) -> Column:
    n = sum((found[c] for c in CLASSES[1:]), found[CLASSES[0]])
    terms = [_term(F.when(n > 0, found[c] / n).otherwise(F.lit(0.0)), F.get(classes, F.lit(i))) for i, c in enumerate(CLASSES)]
    return _distance(F.array(*terms))


def word_distance(hashes: Column, refs: dict[str, Column], bits: int) -> Column:
    """Distance of the common words' counts in ``hashes`` from their shares; other words are one entry.

    The words' places among the common ones are sorted, so the ends of equal runs give the counts.
    """
    shares = refs["shares"]

    def compared(places: Column, n: Column) -> Column:
        ends = F.filter(F.transform(places, lambda x, i: F.when(F.coalesce(F.get(places, i + 1) != x, F.lit(True)), F.struct(x.alias("k"), (i + 1).alias("end")))), lambda r: r.isNotNull())

        def parts(e: Column) -> Column:
            p = lambda r, i: (r["end"] - F.coalesce(F.get(e, i - 1)["end"], F.lit(0))) / n
            q = lambda r: F.get(shares, (r["k"] - 1).cast("int"))
            seen = F.transform(e, lambda r, i: _term(p(r, i), q(r)))
            # a word that the text lacks adds its share times ln 2
            lacking = (F.aggregate(shares, F.lit(0.0), lambda a, b: a + b) - F.aggregate(e, F.lit(0.0), lambda a, r: a + q(r))) * F.log(F.lit(2.0))
            rest = _term(1 - F.size(places) / n, 1 - F.aggregate(shares, F.lit(0.0), lambda a, b: a + b))
            return F.concat(seen, F.array(lacking, rest))

        return _distance(let(ends, parts))

    n = F.size(hashes)
    slot = lambda h: _slot(h, refs["shift"], bits)
    known = F.filter(hashes, lambda h: F.get(refs["slots"], slot(h)) == h)
    by_slot = F.transform(known, lambda h: F.get(refs["places"], slot(h)))
    by_search = F.filter(F.transform(hashes, lambda h: F.array_position(refs["hashes"], h).cast("int")), lambda k: k > 0)
    places = F.sort_array(F.when(refs["shift"].isNotNull(), by_slot).otherwise(by_search))
    return F.when(n > 0, let(places, lambda s: compared(s, n))).otherwise(F.lit(1.0))


def count_rows(docs: DataFrame, word_refs: DataFrame) -> DataFrame:
    """What each document (doc_id, text, lang) yields: base counts, class counts and its word distance; no text.

    ``word_refs`` has one row per language; Spark broadcasts it after measuring its written size.
    """
    rows = _keyed(docs).withColumnRenamed("key", "lang_key")
    known = word_refs.select(F.col("key"), F.lit(True).alias("known"))
    rows = rows.join(known, rows["lang_key"] == known["key"], "left").drop("key")
    rows = rows.withColumn("key", F.when(F.col("known"), F.col("lang_key")).otherwise(F.lit(ALL))).drop("known")
    rows = rows.join(word_refs.select("key", "shares", "hashes", "shift", "slots", "places"), "key", "left")
    refs = {c: F.col(c) for c in ("shares", "hashes", "shift", "slots", "places")}
    bits = (word_refs.select(F.max(F.size("slots"))).first()[0] or 1).bit_length() - 1
    in_words = let(
        F.transform(words_of(F.col("text")), lambda w: F.xxhash64(w)),
        lambda h: F.struct(F.size(h).cast("long").alias("n_words"), repeated_words(h).alias("n_repeat_words"), word_distance(h, refs, bits).alias("word_distance")),
    )
    # asking for both structs in one projection keeps each from being evaluated once per field
    rows = rows.select("doc_id", "lang_key", "key", in_words.alias("w"), char_classes(F.col("text")).alias("c"), duplicate_lines(F.col("text")).alias("n_dup_lines"), F.length("text").alias("chars"))
    return rows.select("doc_id", "lang_key", "key", "w.*", "c", "n_dup_lines", "chars")


def verdicts(counted: DataFrame, class_refs: DataFrame, *, max_class: float = 0.26, max_word: float = 0.42, min_chars: int = 200, min_words: int = 100) -> DataFrame:
    """Base counts, both distances and the verdict for each row of ``count_rows``."""
    rows = counted.join(class_refs.select("key", "classes"), "key", "left")
    rows = rows.withColumn("class_distance", class_distance(F.col("c"), F.col("classes")))
    n, again = F.col("n_words"), F.col("n_repeat_words")
    failed = (n < 50) | (100 * again > 50 * n)
    odd = ((F.col("chars") >= min_chars) & (F.col("class_distance") > max_class)) | ((n >= min_words) & (F.col("word_distance") > max_word))
    return rows.select(
        "doc_id",
        "n_words",
        (F.col("chars") - F.col("c.blanks")).cast("long").alias("word_chars"),
        F.col("c.symbols").alias("n_symbols"),
        "n_dup_lines",
        "n_repeat_words",
        "class_distance",
        "word_distance",
        failed.alias("base_failed"),
        (~failed & ~F.coalesce(odd, F.lit(False))).alias("kept"),
    )


def score_quality(docs: DataFrame, refs: DataFrame, **limits) -> DataFrame:
    """Verdicts on ``docs`` by the ``references`` of any corpus."""
    return verdicts(count_rows(docs, refs), refs, **limits)


def judge(docs: DataFrame, *, common_words: int = 40, min_reference: int = 2000, **limits) -> DataFrame:
    """Verdicts on ``docs`` by their own references, in two passes over the texts."""
    counted = cut_lineage(count_rows(docs, word_references(docs, common_words=common_words, min_reference=min_reference)))
    return verdicts(counted, class_references(counted, min_reference=min_reference), **limits)
