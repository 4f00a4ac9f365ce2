"""Quality rules: word and line counts, and how far a document's histograms are from its language's.

A document's language is the one whose common words it holds most of. Two histograms, of character
classes and of that language's common words, are compared with those of all documents of the language by
Jensen-Shannon distance. Texts that are too short for a histogram are not judged by it.

Only column expressions are used. Words, windows and histograms of a text stay in its row; nothing is
exploded, and the only exchange sums the histograms by language.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

# Common words of each language.
COMMON_WORDS = {
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als".split(),
    "en": "the of and to in a is that it for was on with as be at by this are from".split(),
    "es": "de la que el en y los del se las por un para con una al su es lo como".split(),
    "fr": "de la le les et des en un une que du est pour qui dans par au pas sur avec".split(),
}
# The character classes, in the order in which they are taken out of a text. What is left is another.
CLASSES = ("[a-z]+", r"[\x20\x09-\x0D]+", "[A-Z]+", "[0-9]+", r"[^\x00-\x7F]+", "[#*$%&|<>]+")
SPACE, HIGH, SYMBOL = 1, 4, 5

MIN_WORDS = 50
MIN_HISTOGRAM_WORDS = 100
MAX_CLASS_DISTANCE = 0.30
MAX_WORD_DISTANCE = 0.29


def bind(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def repeated_words(words: Column) -> Column:
    """How many of the words lie in a window of three that occurs more than once."""
    size = F.size(words)
    windows = F.when(
        size >= 3,
        F.transform(F.sequence(F.lit(0), size - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))),
    )

    def covered(hashes: Column) -> Column:
        placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return bind(placed, lambda s: F.aggregate(repeats(s), start, add, lambda state: state["n"]))

    def repeats(s: Column) -> Column:
        def twice(x: Column, k: Column) -> Column:
            before, after = F.get(s, k - 1)["h"], F.get(s, k + 1)["h"]
            return F.coalesce(before == x["h"], F.lit(False)) | F.coalesce(after == x["h"], F.lit(False))

        return F.array_sort(F.transform(F.filter(s, twice), lambda x: x["i"]))

    start = F.struct(F.lit(0).alias("to"), F.lit(0).cast("long").alias("n"))

    def add(state: Column, i: Column) -> Column:
        return F.struct((i + 3).alias("to"), (state["n"] + i + 3 - F.greatest(state["to"], i)).alias("n"))

    unique = lambda h: F.size(F.array_distinct(h)) == F.size(h)
    found = bind(windows, lambda h: F.when(h.isNull() | unique(h), F.lit(0).cast("long")).otherwise(covered(h)))
    return F.coalesce(found, F.lit(0).cast("long"))


def _is_one_of(words: list[str]):
    return lambda w: w.isin(words)


def measured(docs: DataFrame) -> DataFrame:
    """Counts and histograms of every row of ``docs`` (text), which comes along whole as ``row``."""
    out = docs.select(F.struct("*").alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = out.withColumn("words", words_of(F.col("text"))).withColumn("lines", lines).withColumn("left", F.col("text"))
    sizes = [f"c{k}" for k in range(len(CLASSES) + 1)]
    for name, pattern in zip(sizes, CLASSES, strict=False):
        out = out.withColumn("rest", F.regexp_replace("left", pattern, ""))
        out = out.withColumn(name, (F.length("left") - F.length("rest")).cast("long")).drop("left")
        out = out.withColumnRenamed("rest", "left")
    out = out.withColumn(sizes[-1], F.length("left").cast("long"))
    every = sorted({w for words in COMMON_WORDS.values() for w in words})
    hits = F.transform(F.filter("words", lambda w: F.lower(w).isin(every)), lambda w: F.lower(w))
    out = out.select(
        "row",
        F.size("words").cast("long").alias("n_words"),
        sum(F.col(c) for k, c in enumerate(sizes) if k != SPACE).alias("word_chars"),
        F.col(sizes[SYMBOL]).alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        bind(F.col("words"), repeated_words).alias("n_repeat_words"),
        # What lies above ASCII counts as letters, so that scripts do not tell languages apart here.
        F.array(*[F.col(c) + F.col(sizes[HIGH]) if k == 0 else F.col(c) for k, c in enumerate(sizes) if k != HIGH]).alias("classes"),
        hits.alias("hits"),
    )
    among = {name: F.array_size(F.filter("hits", _is_one_of(own))) for name, own in COMMON_WORDS.items()}
    counts = F.array(*[F.struct(n.alias("n"), F.lit(name).alias("language")) for name, n in among.items()])
    # Of languages with as many hits the first by name; without a hit there is no language.
    best = F.array_sort(counts, lambda a, b: F.when(a["n"] != b["n"], b["n"] - a["n"]).when(a["language"] < b["language"], -1).otherwise(1))
    out = out.withColumn("best", best[0])
    out = out.withColumn("language", F.when(F.col("best.n") > 0, F.col("best.language"))).drop("best")
    histogram = F.lit(None).cast("array<bigint>")
    for name, own in COMMON_WORDS.items():
        in_order = F.transform(
            F.array(*[F.lit(w) for w in own]), lambda w: F.size(F.filter("hits", lambda h: h == w)).cast("long")
        )
        histogram = F.when(F.col("language") == name, in_order).otherwise(histogram)
    total = lambda x: F.aggregate(x, F.lit(0).cast("long"), lambda a, b: a + b)
    out = out.withColumn("found", histogram).drop("hits")
    common = F.concat(F.array(F.col("n_words") - total(F.col("found"))), F.col("found"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.withColumn("common", common).withColumn("base_failed", failed).drop("found")


def references(rows: DataFrame) -> DataFrame:
    """Summed histograms of documents that pass the base rules: a row per language, and one of all (null)."""
    usable = rows.filter("language is not null and not base_failed")

    def summed(name: str, size: int) -> Column:
        return F.array(*[F.sum(F.get(F.col(name), F.lit(k))) for k in range(size)]).alias(f"{name}_sum")

    bins = 1 + max(map(len, COMMON_WORDS.values()))
    return usable.rollup("language").agg(summed("classes", len(CLASSES)), summed("common", bins))


def distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance (base 2) of two histograms of counts, 0 to 1; null if one is empty."""
    total = lambda x: F.aggregate(x, F.lit(0.0), lambda a, b: a + F.coalesce(b, F.lit(0)))

    def part(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)

    def js(n: Column, r: Column) -> Column:
        def one(x: Column, y: Column) -> Column:
            p, q = F.coalesce(x, F.lit(0)) / n, F.coalesce(y, F.lit(0)) / r
            return part(p, (p + q) / 2) + part(q, (p + q) / 2)

        return F.aggregate(F.zip_with(counts, reference, one), F.lit(0.0), lambda a, b: a + b) / 2

    value = bind(total(counts), lambda n: bind(total(reference), lambda r: F.when((n > 0) & (r > 0), js(n, r))))
    return F.sqrt(F.abs(value))  # equal histograms may come out a hair below zero


def _judged(rows: DataFrame, known: DataFrame, max_class_distance: float, max_word_distance: float) -> DataFrame:
    """``rows`` of :func:`measured` with distances to the ``known`` references and the verdict."""
    known = F.broadcast(known.withColumnRenamed("language", "of"))  # a row for each language above, and one more
    out = rows.join(known, F.col("language").eqNullSafe(F.col("of")), "left")
    long_enough = F.col("n_words") >= MIN_HISTOGRAM_WORDS
    of_words = long_enough & F.col("language").isNotNull()
    out = out.select(
        "row",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "language",
        F.when(long_enough, distance(F.col("classes"), F.col("classes_sum"))).alias("class_distance"),
        F.when(of_words, distance(F.col("common"), F.col("common_sum"))).alias("word_distance"),
    )
    near = (F.coalesce("class_distance", F.lit(0.0)) <= max_class_distance) & (
        F.coalesce("word_distance", F.lit(0.0)) <= max_word_distance
    )
    return out.withColumn("kept", ~F.col("base_failed") & near)


def judge(
    docs: DataFrame, max_class_distance: float = MAX_CLASS_DISTANCE, max_word_distance: float = MAX_WORD_DISTANCE
) -> DataFrame:
    """Counts, distances and verdict of every row of ``docs`` (doc_id, text): one row out for each row in.

    A null text has no words and fails the base rules, as does any text of fewer than ``MIN_WORDS`` words.
    Documents of fewer than ``MIN_HISTOGRAM_WORDS`` words are judged by the base rules alone; their distances
    are null. Those without a common word of any language are held against the classes of all documents.
    Repeated rows count each; other columns are not read.
    """
    rows = measured(docs.select("doc_id", "text"))
    rows = stored(rows.withColumn("row", F.struct("row.doc_id")))
    return _judged(rows, references(rows), max_class_distance, max_word_distance).select("row.*", "*").drop("row")


def keep(
    docs: DataFrame, max_class_distance: float = MAX_CLASS_DISTANCE, max_word_distance: float = MAX_WORD_DISTANCE
) -> DataFrame:
    """The rows of ``docs`` that :func:`judge` keeps, with all their columns. Texts are measured twice, never sent."""
    known = stored(references(measured(docs.select("text"))))
    return _judged(measured(docs), known, max_class_distance, max_word_distance).filter("kept").select("row.*")
