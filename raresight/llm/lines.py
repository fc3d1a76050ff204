"""Line dedup within an edit bound: a line goes when an earlier line is equal or one word away.

Lines are compared as sequences of words.  Equal lines meet by a 128-bit hash.  For lines of at least
``min_words`` words the edit bound is one word (inserted, deleted or replaced), found by a deletion-
neighbourhood join: each line emits the hash of itself and of itself without each of its words;
lines whose hashes are equal are candidates, and the two remaining word sequences are compared word for word
before anything is removed.  Only minima per hash are joined, never all pairs of a group.

To keep the neighbourhood small, lines that can have no neighbour are left out first, losing none:
where one word differs, either the first or the last words (nearly half the line) are equal, so a line takes
part only if its first or its last words occur in another line.

The earliest line (doc_id, then line number) stays; a null doc_id comes first.  Lines without a word and null
texts are left alone.  Rows with equal doc_id and equal text are the same place, so both stay; with
different texts they are ordered by line number, then by a hash of the text.  An empty table gives an
empty table; other columns may have any name, those of ``keep`` any but the result's (pass them as one struct).  Everything is DataFrame and SQL functions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from raresight.llm.common import written

# lines are cut at line feeds, so the other white space of the contracts is left: made blanks, then cut at blanks
WORDS = r"array_remove(split(translate(line, '\t\u000b\u000c\r', '    '), ' '), '')"
STEP = 8  # lengths of one class share the length of their compared ends
FLOOR = 2  # of a line of one word nothing is left to compare
PLACE = ("d", "l", "t")  # doc_id, line number, hash of the text: the order of lines


def numbered(docs: DataFrame, text: str) -> DataFrame:
    """docs with d and t."""
    return docs.withColumns({"d": F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))), "t": F.hash(text)})


def place(prefix: str = "") -> Column:
    return F.struct(*[F.col(prefix + c).alias(c) for c in PLACE])


def hashed_lines(docs: DataFrame, text: str, min_words: int) -> DataFrame:
    """One row per line with a word: its place, 128-bit hash (h1, h2) and the keys of its ends."""
    lines = numbered(docs.select("doc_id", F.col(text).alias("text")), "text").select("d", "t", F.posexplode(F.split("text", "\n")).alias("l", "line"))
    named = lines.select("d", "t", "l", F.expr(WORDS).alias("words")).filter(F.size("words") > 0).withColumn("n", F.size("words"))
    # a line of n words meets lines of n and n + 1 words (as the shorter) and of n - 1 (as the longer); classes of
    # lengths c >= 1 share their ends' size, below them every length m of the shorter is a class (-m) of its own
    long = f"transform(filter(array_distinct(array(n div {STEP}, (n + 1) div {STEP})), c -> c > 0), c -> struct(c as c, int((c * {STEP} - 1) div 2) as size))"
    short = f"transform(filter(array(n - 1, n), m -> m >= {min_words} and m < {STEP - 1}), m -> struct(cast(-m as bigint) as c, int(m div 2) as size))"
    kinds = f"if(n < {min_words}, array(), concat({long}, {short}))" if min_words < STEP else f"if(n < {min_words}, array(), {long})"
    ends = f"flatten(transform({kinds}, k -> array(xxhash64(1, k.c, slice(words, 1, k.size)), xxhash64(2, k.c, slice(words, n - k.size + 1, k.size)))))"
    return named.select("d", "t", "l", F.xxhash64("words").alias("h1"), F.xxhash64(F.lit(1), "words").alias("h2"), F.expr(ends).alias("ends"))


def neighbourhood(lines: DataFrame) -> DataFrame:
    """(place, pos, key) for each line: itself (pos 0) and itself without its pos-th word.

    The key is a hash of sums over neighbouring words' hashes, so each variant costs a few operations
    whatever the line's length.  Equal sequences have equal keys; the few others that do are told apart later."""
    pair = "xxhash64(coalesce(get(words, i - 1), ''), coalesce(get(words, i), ''))"
    skip = "xxhash64(coalesce(get(words, i - 1), ''), coalesce(get(words, i + 1), ''))"
    high, low = (lambda x: f"shiftrightunsigned({x}, 32)"), (lambda x: f"({x} & 4294967295)")
    paired = lines.withColumn("g", F.expr(f"transform(sequence(0, size(words)), i -> {pair})"))
    summed = paired.withColumns({"s1": F.expr(f"aggregate(g, 0L, (a, x) -> a + {high('x')})"), "s2": F.expr(f"aggregate(g, 0L, (a, x) -> a + {low('x')})")})
    without = [f"s{k} - {part('g[i]')} - {part('g[i + 1]')} + {part(skip)}" for k, part in ((1, high), (2, low))]
    variants = f"concat(array(struct(0 as pos, xxhash64(s1, s2) as key)), transform(sequence(0, size(words) - 1), i -> struct(i + 1 as pos, xxhash64({without[0]}, {without[1]}) as key)))"
    return summed.select(*PLACE, F.explode(F.expr(variants)).alias("x")).select(*PLACE, "x.pos", "x.key")


def remainder(words: str, pos: str) -> str:
    return f"if({pos} = 0, {words}, concat(slice({words}, 1, {pos} - 1), slice({words}, {pos} + 1, size({words}))))"


def near_duplicates(docs: DataFrame, text: str, distinct: DataFrame) -> DataFrame:
    """Places of first occurrences that are one word away from an earlier line."""
    ends = distinct.select(F.explode("ends").alias("end"), "h1", "h2", "first.*")
    common = ends.groupBy("end").agg((F.min(F.struct("h1", "h2")) != F.max(F.struct("h1", "h2"))).alias("more")).filter("more").select("end")
    chosen = ends.join(common, "end", "left_semi").groupBy("d", "t").agg(F.collect_set("l").alias("ls"))
    # the text is split once: an array of one element carries the lines into the inner function
    wanted = F.expr("transform(array(split(text, '\\n')), a -> transform(ls, l -> struct(l as l, get(a, l) as line)))[0]")
    lines = (numbered(docs.select("doc_id", F.col(text).alias("text")), "text").join(chosen, ["d", "t"])
             .select("d", "t", F.explode(wanted).alias("x")).select("d", "t", "x.l", "x.line").select(*PLACE, F.expr(WORDS).alias("words")))
    lines = written(lines.dropDuplicates(list(PLACE)), "line-words")

    # most variants meet no other: a key's least and greatest line tell, and they combine before the shuffle
    line = F.xxhash64(*PLACE)
    variants = neighbourhood(lines)
    meeting = variants.groupBy("key").agg(F.min(line).alias("least"), F.max(line).alias("most")).filter("least <> most").select("key")  # a line may meet itself
    meeting = written(meeting, "line-keys")
    # those that do are told apart by a hash of the very words that are left
    met = written(variants.join(meeting, "key", "left_semi").select(*PLACE, "pos").join(lines, list(PLACE)).withColumn("left", F.expr(remainder('words', 'pos')))
                  .select(*PLACE, "pos", F.xxhash64("left").alias("r1"), F.xxhash64(F.lit(1), "left").alias("r2")), "line-remainders")
    # the earliest line of each remainder, by how it got there: as it is, without any one word, without this word
    of_rest = met.groupBy("r1", "r2").agg(F.min(F.when(F.col("pos") == 0, place())).alias("whole"), F.min(F.when(F.col("pos") > 0, F.struct(*PLACE, "pos"))).alias("shorter"))
    of_pos = met.groupBy("r1", "r2", "pos").agg(F.min(place()).alias("same"))
    met = met.join(of_rest, ["r1", "r2"]).join(of_pos, ["r1", "r2", "pos"])
    own = place()
    earlier = F.array(
        F.when((F.col("pos") > 0) & (F.col("same") < own), F.struct(F.col("same").alias("at"), F.col("pos").alias("other"))),
        F.when((F.col("pos") > 0) & (F.col("whole") < own), F.struct(F.col("whole").alias("at"), F.lit(0).alias("other"))),
        F.when((F.col("pos") == 0) & (F.struct(*[F.col(f"shorter.{c}").alias(c) for c in PLACE]) < own),
               F.struct(F.struct(*[F.col(f"shorter.{c}").alias(c) for c in PLACE]).alias("at"), F.col("shorter.pos").alias("other"))))
    candidates = met.select(*PLACE, "pos", F.explode(F.filter(earlier, lambda x: x.isNotNull())).alias("x")).select(
        *PLACE, "pos", "x.other", *[F.col(f"x.at.{c}").alias(f"{c}_") for c in PLACE])
    # word for word: what is left of the two lines must be equal
    both = candidates.join(lines, list(PLACE)).join(lines.select(*[F.col(c).alias(f"{c}_") for c in PLACE], F.col("words").alias("words_")), [f"{c}_" for c in PLACE])
    return both.filter(F.expr(f"{remainder('words', 'pos')} = {remainder('words_', 'other')}")).select(*PLACE).distinct()


def removed_lines(docs: DataFrame, text: str, min_words: int) -> DataFrame:
    """One row per document (d, t) that loses lines: gone (their numbers)."""
    lines = written(hashed_lines(docs, text, min_words), "hashed-lines")
    distinct = written(lines.groupBy("h1", "h2").agg(F.min(place()).alias("first"), F.count("*").alias("n"), F.any_value("ends").alias("ends")), "distinct-lines")
    near = near_duplicates(docs, text, distinct)
    repeated = distinct.filter("n > 1").select("h1", "h2", "first")
    exact = lines.select(*PLACE, "h1", "h2").join(repeated, ["h1", "h2"]).filter(F.col("first") < place()).select(*PLACE)
    return exact.union(near).groupBy("d", "t").agg(F.collect_set("l").alias("gone"))


def dedup_lines(docs: DataFrame, text: str = "text", min_words: int = FLOOR, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, n_lines (all lines of the text), n_removed and ``kept_text`` (the other lines, joined by line ends;
    null for null)."""
    if min_words < FLOOR:
        raise ValueError(f"min_words must be at least {FLOOR}")
    gone = removed_lines(docs, text, min_words).withColumnsRenamed({"d": "__d", "t": "__t", "gone": "__gone"})
    rows = docs.select(F.struct(*keep).alias("__row"), F.col(text).alias("__text"),
                       F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("__d"), F.hash(text).alias("__t"))
    kept = "if(__gone is null, __text, array_join(filter(split(__text, '\\n'), (x, i) -> not array_contains(__gone, i)), '\\n'))"
    joined = rows.join(gone, ["__d", "__t"], "left")
    return joined.select("__row.*", F.coalesce(F.size(F.split("__text", "\n")), F.lit(0)).cast("long").alias("n_lines"),
                         F.coalesce(F.size("__gone"), F.lit(0)).cast("long").alias("n_removed"), F.expr(kept).alias("kept_text"))
