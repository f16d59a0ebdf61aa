"""Benchmark passages in documents, also with other numbers, names and units, found by templates.

Only column expressions. Numbers, names and units become typed placeholders; windows of the resulting
templates are joined by hash; the values in the placeholders must correspond one to one. Windows with
hardly a word outside placeholders, and items shorter than a window, are joined by their own words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import stage

WIDTH = 8
#: A window is joined by its template if it has so many words that are no placeholders.
CONSTANT = 3
NUMBER, NAME, UNIT = "\ue000", "\ue001", "\ue002"
#: Units that may follow a number, and number words.
UNITS = (
    "km m cm mm kg g mg lb oz l ml s ms min h hr hrs hour hours minute minutes second seconds day days week weeks "
    "month months year years mile miles inch inches foot feet meter meters metre metres gram grams liter liters "
    "percent dollars euros cents kmh mph"
).split()
NUMBER_WORDS = "two three four five six seven eight nine ten eleven twelve twenty thirty forty fifty hundred thousand million".split()
_BLANK = r"[\x20\x09-\x0D]+"
_KIND = rf"\p{{L}}\p{{N}}{NUMBER}{NAME}{UNIT}"


def words(text):
    return F.filter(F.split(text, _BLANK), lambda w: w != "")


def template(text):
    """Words of the text in lower case without outer punctuation, placeholders for slots; as many as before."""
    names = F.regexp_replace(text, r"(?<=[^.!?:;\s]\s)\p{Lu}\p{Ll}{2,}(?!\p{L})", NAME)
    numbers = F.regexp_replace(
        F.lower(names), r"(?<![\p{L}\p{N}])(?:[-+]?\d+(?:[.,]\d+)*|(?:" + "|".join(NUMBER_WORDS) + r")(?!\p{L}))", NUMBER
    )
    units = F.regexp_replace(numbers, NUMBER + r"(\s?)(?:" + "|".join(sorted(UNITS, key=len, reverse=True)) + r"|%)(?![\p{L}\p{N}])", NUMBER + "$1" + UNIT)
    trimmed = F.regexp_replace(units, rf"(?<=[{_KIND}])[^{_KIND}\s]+(?=\s|$)|(?<=\s|^)[^{_KIND}\s]+(?=[{_KIND}])", "")
    return words(trimmed)


def _doubled(h, by: int):
    """Hashes of runs of twice ``by`` words from those of ``by`` words."""
    n = F.size(h) - by
    both = F.zip_with(F.slice(h, F.lit(1), n), F.slice(h, F.lit(by + 1), n), lambda a, b: F.xxhash64(a, b))
    return F.when(n > 0, both).otherwise(F.array().cast("array<long>"))


def _window_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, at, window): one row per window of ``tokens``."""
    df = df.select(*keys, F.transform("tokens", lambda t: F.xxhash64(t)).alias("h"))
    for by in (1, 2, 4):  # pairs, fours, eights
        df = df.select(*keys, _doubled(F.col("h"), by).alias("h"))
    return df.select(*keys, F.posexplode_outer("h").alias("at", "window"))


def _bare(w):
    """A word in lower case without outer punctuation; one of punctuation alone stays."""
    inner = F.regexp_replace(F.lower(w), r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")
    return F.when(inner == "", w).otherwise(inner)


def _is_slot(token):
    return token.rlike(f"[{NUMBER}{NAME}{UNIT}]")


def _plain_windows(items: DataFrame) -> DataFrame:
    """(item, item_at, n, window): what is joined by its own words, ``n`` words long.

    Windows with under ``CONSTANT`` words outside placeholders, and whole items of under ``WIDTH`` words.
    """
    plain = F.transform("raw", _bare)
    n = F.least(F.size("tokens"), F.lit(WIDTH))
    at = F.explode(F.sequence(F.lit(0), F.size("tokens") - n)).alias("item_at")
    rows = items.where(F.size("tokens") > 0).select("item", "tokens", plain.alias("plain"), n.alias("n"), at)
    part = F.slice("tokens", F.col("item_at") + 1, F.col("n"))
    weak = (F.col("n") < WIDTH) | (F.size(F.filter(part, lambda t: ~_is_slot(t))) < CONSTANT)
    return rows.where(weak).select("item", "item_at", "n", F.xxhash64(F.slice("plain", F.col("item_at") + 1, F.col("n"))).alias("window"))


def _runs(plain, n: int):
    """Hashes of all runs of ``n`` words; there are at least ``n``."""
    return F.transform(F.sequence(F.lit(0), F.size(plain) - n), lambda i: F.xxhash64(F.slice(plain, i + 1, F.lit(n))))


def _plain_hits(texts: DataFrame, windows: DataFrame) -> DataFrame | None:
    """(mark, item, at, item_at) of documents that hold the words of plain windows; None without such windows.

    One pass over the documents for each length that occurs, of which there are at most ``WIDTH``.
    """
    out = None
    for n in sorted(r.n for r in windows.select("n").distinct().collect()):
        plain = texts.select("mark", F.transform(words(F.col("t")), _bare).alias("plain")).where(F.size("plain") >= n)
        held = plain.select("mark", F.posexplode(_runs(F.col("plain"), n)).alias("at", "window"))
        hits = held.join(windows.where(F.col("n") == n), "window").select("mark", "item", "at", "item_at")
        out = hits if out is None else out.unionByName(hits)
    return out


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", coverage: float = 0.5
) -> DataFrame:
    """(mark, item_id, covered): the item texts that a document, by the hash of its text, holds.

    An item counts as held if windows that agree with it cover at least ``coverage`` of its words. Windows
    with one offset between item and document agree if the values of their slots correspond one to one.
    Windows with under ``CONSTANT`` words outside slots agree with their own words only, and items of
    under ``WIDTH`` words are held if they stand whole in the document, with their own values.
    """
    text = F.col(f"`{text_col}`")
    items = benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text).alias("t")).where("t is not null")
    # Equal texts count as one item.
    items = items.groupBy("t").agg(F.min("item_id").alias("item_id")).select(
        F.xxhash64("t").alias("item"), "item_id", words(F.col("t")).alias("raw"), template(F.col("t")).alias("tokens")
    )
    items = stage(items, "items")
    strong = _window_rows(items, ["item", "tokens"])
    part = F.slice("tokens", F.col("at") + 1, F.lit(WIDTH))
    strong = strong.where(F.size(F.filter(part, lambda t: ~_is_slot(t))) >= CONSTANT)
    item_windows = stage(strong.select("item", F.col("at").alias("item_at"), "window"), "item_windows")
    doc_texts = docs.where(text.isNotNull()).select(F.xxhash64(text).alias("mark"), text.alias("t"))
    doc_tokens = doc_texts.select("mark", template(F.col("t")).alias("tokens"))
    hits = _window_rows(doc_tokens, ["mark"]).join(item_windows, "window").select("mark", "item", "at", "item_at")
    plain_hits = _plain_hits(doc_texts, stage(_plain_windows(items), "plain_windows"))
    if plain_hits is not None:
        hits = hits.unionByName(plain_hits)
    hits = hits.select("mark", "item", (F.col("at") - F.col("item_at")).alias("offset"), "item_at").distinct()
    runs = stage(hits.groupBy("mark", "item", "offset").agg(F.collect_set("item_at").alias("starts")), "runs")
    met = runs.select("mark").distinct()
    texts = doc_texts.join(met, "mark", "left_semi").groupBy("mark").agg(F.any_value("t").alias("t")).select("mark", words(F.col("t")).alias("doc_raw"))
    def places(start):
        return F.sequence(start, F.least(start + F.lit(WIDTH - 1), F.size("tokens") - 1))
    placed = F.array_distinct(F.flatten(F.transform("starts", places)))
    full = runs.join(items, "item").join(texts, "mark").withColumn("places", placed)
    slots = F.filter("places", lambda i: _is_slot(F.element_at("tokens", i + 1)))
    pairs = F.transform(slots, lambda i: F.struct(_bare(F.element_at("raw", i + 1)).alias("x"), _bare(F.element_at("doc_raw", i + F.col("offset") + 1)).alias("y")))
    agreed = full.withColumn("pairs", F.array_distinct(pairs)).where(
        "size(pairs) = size(array_distinct(pairs.x)) and size(pairs) = size(array_distinct(pairs.y))"
    )
    whole = agreed.groupBy("mark", "item", "item_id", F.size("tokens").alias("n")).agg(
        F.size(F.array_distinct(F.flatten(F.collect_set("places")))).alias("k")
    )
    return whole.where(F.col("k") >= coverage * F.col("n")).select("mark", "item_id", (F.col("k") / F.col("n")).alias("covered"))


def mark_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(id, contaminated, n_items, first_item, covered), one row for each input row.

    ``first_item`` is the smallest id among the items held, ``covered`` the largest covered share of an
    item. Items of under 8 words are found whole only, case and outer punctuation aside. Null and empty
    texts hold nothing; null and empty item texts are ignored; with an empty benchmark nothing is contaminated. Repeated rows are
    judged alike; other columns are ignored.
    """
    leaks = find_leaks(docs, benchmark, text_col, **options)
    by = stage(
        leaks.groupBy("mark").agg(F.count("*").alias("n_items"), F.min("item_id").alias("first_item"), F.max("covered").alias("covered")),
        "leaks",
    )
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.col(f"`{text_col}`")).alias("mark"))
    return rows.join(by, "mark", "left").select(
        F.col("id").alias(id_col), F.col("n_items").isNotNull().alias("contaminated"),
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"), "first_item", F.round("covered", 6).alias("covered"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, all columns."""
    marks = stage(find_leaks(docs, benchmark, text_col, **options).select(F.col("mark").alias("__mark")).distinct(), "leaks")
    return docs.withColumn("__mark", F.xxhash64(F.col(f"`{text_col}`"))).join(marks, "__mark", "left_anti").drop("__mark")
