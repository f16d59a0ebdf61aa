"""Spelling variants by permuterm rotations.

A word is marked with a terminator and rotated in all ways. In the rotation that starts after a
character, that character comes last: words that differ in it alone share the prefix before it, and the
word without it has that prefix as a whole rotation of its own. With all rotations sorted, the words
near each other form runs of one prefix, which a scan reads in turn. A run holds at most one word per
letter of the alphabet, and one shorter word.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import discard, stage

#: A character that no word holds.
MARK = "\u0000"
#: Distinct words that a task holds before it hands their counts on.
HELD = 300_000
#: Latin-1 letters as themselves, A-Z lower-cased, all else blank. A-Z, a-z, U+00C0 to U+00FF.
_LETTERS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0xC0 else 0x20 for b in range(256))
#: Characters of a text that are cut into words at once.
SLICE = 1 << 22


def _runs(text: str) -> Iterator[bytes]:
    """The lower-cased runs of letters of a whole text, in Latin-1."""
    if len(text) <= SLICE:
        yield from text.encode("latin-1", "replace").translate(_LETTERS).split()
        return
    left = b""
    for at in range(0, len(text), SLICE):
        data = left + text[at : at + SLICE].encode("latin-1", "replace").translate(_LETTERS)
        *whole, left = data.split(b" ")
        yield from filter(None, whole)
    if left:
        yield left


def count_words(
    df: DataFrame, min_length: int = 6, min_count: int = 5, typo_every: int | None = None,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(word, n): runs of Latin letters of all texts, A-Z lower-cased, and how often they occur.

    Words have at least ``min_length`` code points and ``min_count`` occurrences. With ``typo_every``, a
    run loses one code point where the CRC-32 of "<id>:<run>" is divisible by that number: planted
    mistakes, for tests. Null texts hold no words; a null id counts as an empty one. Repeated rows count
    each time. Tasks add up before the shuffle, and hand on at a fixed number of words held.
    """
    cols = df.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{text_col}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[bytes, int] = {}

        def handed() -> pa.RecordBatch:
            words = [w.decode("latin-1") for w in total]
            out = pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"])
            total.clear()
            return out

        for batch in batches:
            for doc, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if not text:
                    continue
                start = zlib.crc32(f"{doc or ''}:".encode())
                for word, n in Counter(_runs(text)).items():
                    if typo_every:
                        h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
                        if h % typo_every == 0:
                            gone = h % len(word)
                            word = word[:gone] + word[gone + 1 :]
                    if len(word) >= min_length:
                        total[word] = total.get(word, 0) + n
                if len(total) >= HELD:
                    yield handed()
        yield handed()

    counts = cols.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= min_count)


def rotations(words: DataFrame) -> DataFrame:
    """(prefix, letter, n): of each word its rotations, whole (letter is empty) and without their last letter.

    The rotation of a word ``axb`` that starts after ``x`` gives the prefix ``b`` + mark + ``a`` and the
    letter ``x``; so does the rotation of ``ab`` that starts at ``b``, as a whole.
    """
    n = F.length("word")
    marked = F.concat("word", F.lit(MARK))
    cut = words.select("word", "n", F.explode(F.sequence(F.lit(0), n)).alias("at"))
    turned = F.concat(F.expr("substring(marked, at + 1)"), F.expr("substring(marked, 1, at)"))
    whole = cut.withColumn("marked", marked).select("n", "at", turned.alias("r"))
    # A rotation from position 0 ends with the mark: there is no letter before it.
    parts = F.array(
        F.struct(F.col("r").alias("prefix"), F.lit("").alias("letter")),
        F.when(F.col("at") > 0, F.struct(F.expr("left(r, length(r) - 1)").alias("prefix"), F.right("r", F.lit(1)).alias("letter"))),
    )
    return whole.select("n", F.explode(F.filter(parts, lambda p: p.isNotNull())).alias("p")).select("p.prefix", "p.letter", "n")


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Read sorted rotations run by run; give each member its number of neighbours there and the best."""
    held = None
    for batch in _and_end(batches):
        if batch is None:
            table, last = held, True
        else:
            table = pa.Table.from_batches([batch])
            table, last = (pa.concat_tables([held, table]) if held is not None else table).combine_chunks(), False
        if table is None or not table.num_rows:
            continue
        prefix = table.column("prefix").combine_chunks()
        same = pc.equal(prefix.slice(1), prefix.slice(0, len(prefix) - 1)).to_numpy(zero_copy_only=False)
        edges = [0, *((~same).nonzero()[0] + 1).tolist(), len(prefix)]
        if not last:  # the last run may go on
            held = table.slice(edges[-2])
            edges.pop()
        letters, counts = table.column("letter").to_pylist(), table.column("n").to_pylist()
        out: tuple[list, ...] = ([], [], [], [])
        for a, b in zip(edges, edges[1:], strict=False):
            if b - a > 1:
                _near(prefix[a].as_py(), letters[a:b], counts[a:b], out)
        if out[0]:
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string()), pa.array(out[3], pa.int64())],
                ["word", "near", "form", "form_n"],
            )


def _and_end(batches: Iterator) -> Iterator:
    yield from batches
    yield None


def _near(prefix: str, letters: list[str], counts: list[int], out: tuple[list, ...]) -> None:
    """Neighbours within one run; a doubled letter counts as lost or gained at its first place only."""
    after, _, before = prefix.partition(MARK)
    longer = sorted((-n, f"{before}{x}{after}", x) for x, n in zip(letters, counts, strict=True) if x)
    shorter = next(((-n, before + after) for x, n in zip(letters, counts, strict=True) if not x), None)
    grown = 0
    for k, (n, word, x) in enumerate(longer):
        near, best = len(longer) - 1, None
        if near:
            best = longer[1 if k == 0 else 0][:2]
        if shorter and not before.endswith(x):
            near += 1
            best = min(best, shorter) if best else shorter
            if not grown:
                first_longer = (n, word)
            grown += 1
        if near:
            _put(out, word, near, best)
    if grown:
        _put(out, shorter[1], grown, first_longer)


def _put(out: tuple[list, ...], word: str, near: int, best: tuple[int, str]) -> None:
    for column, value in zip(out, (word, near, best[1], -best[0]), strict=True):
        column.append(value)


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n_near, best, best_n) of the words with a neighbour at one inserted, deleted or replaced letter.

    ``best`` is the neighbour of largest n, of those the smallest in code-point order.
    """
    runs = rotations(words).repartitionByRange("prefix").sortWithinPartitions("prefix", "letter")
    found = runs.mapInArrow(_scan, "word string, near long, form string, form_n long")
    best = F.min(F.struct((-F.col("form_n")).alias("n"), F.col("form").alias("form")))
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", F.col("b.form").alias("best"), (-F.col("b.n")).alias("best_n")
    )


def _ends(forms: DataFrame) -> DataFrame:
    """(word, root): where the forms lead in the end. Each round doubles the steps taken.

    A form has several times the count of its word, so there are no circles and chains are short.
    """
    now = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = now.select(F.col("word").alias("at"), F.col("root").alias("on"))
        step = now.join(on, F.col("root") == F.col("at"), "left")
        after = stage(step.select("word", F.coalesce("on", "root").alias("root"), F.col("on").isNotNull().alias("moved")), "roots")
        discard(now)
        now = after.select("word", "root")
        now.staged_path = after.staged_path
        if after.where("moved").isEmpty():
            return now


def group_variants(words: DataFrame, ratio: int = 5) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every row of (word, n).

    ``form`` is the near word of largest n, if that is at least ``ratio`` times the word's; ``root`` is the
    word that forms lead to, the word itself if it has none. ``ratio`` must be over 1. Words must be
    distinct and hold no U+0000; null words and counts are left out. No words give no rows.
    """
    vocabulary = stage(words.select("word", "n").where("word is not null and n is not null"), "words")
    near = stage(neighbours(vocabulary), "near")
    joined = stage(
        vocabulary.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(F.col("best_n") >= ratio * F.col("n"), F.col("best")).alias("form"),
            F.when(F.col("best_n") >= ratio * F.col("n"), F.col("best_n")).alias("form_n"),
        ),
        "forms",
    )
    discard(vocabulary, near)
    roots = _ends(joined.where("form is not null"))
    return joined.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
