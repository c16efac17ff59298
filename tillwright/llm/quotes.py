"""Chat formatting: quotation linking.

A line that begins with one or more ``>`` is quoted, its level their number. Quoted text is taken out of a message, with
the line that names whom it quotes. Runs of lines of one level are quoted passages; normalised (lower case, words with one
blank between them) and hashed, they, their single lines and the sentences of those that are not found are joined to the
unquoted text of earlier messages of the conversation: to its paragraphs, lines and sentences or, where none of them is
the same, to any run of words. These are found by their first words and compared in full. The message that most quoted text comes from is the one replied to; a message without such
a link replies to the turn before it. Messages are numbered in an order in which every reply follows its original.

All of it is built-in expressions. Running values along a conversation are made in two steps, inside stretches of turns
and then over the stretches, so that a conversation with a large part of all rows is not one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tillwright.session import materialise

# Turns of a conversation that are looked at in one window.
STRETCH = 1024
# Marks of quotation, and lines that introduce one, in the languages of the tables.
_MARKS = r"^(?:[ \t]*>)+"
_SENTENCES = r"(?<=[.!?])\s+"
# First words that a passage is looked up by; shorter ones by the next smaller number.
_FIRST_WORDS = (8, 4, 2, 1)
_INTRODUCES = r"(?i)^\s*(?:on|am|le|el)\s.*(?:wrote|schrieb.*|a écrit|escribió)\s*:\s*$"


def _lines(text: Column) -> Column:
    """Lines as (level, body, introduces a quotation)."""
    raw = F.split(text, "\n")
    level = F.transform(raw, lambda x: F.length(F.regexp_replace(F.regexp_extract(x, f"({_MARKS})", 1), "[^>]", "")))
    ahead = F.concat(F.slice(level, 2, F.size(level)), F.array(F.lit(0)))
    return F.transform(
        F.arrays_zip(raw.alias("raw"), level.alias("level"), ahead.alias("ahead")),
        lambda x: F.struct(
            x["level"].alias("level"),
            F.regexp_replace(x["raw"], _MARKS, "").alias("body"),
            ((x["level"] == 0) & (x["ahead"] > 0) & x["raw"].rlike(_INTRODUCES)).alias("introduces"),
        ),
    )


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def parsed(messages: DataFrame) -> DataFrame:
    """``row``, ``conv_id``, ``turn``, ``role``, ``text`` without quotations, ``n_quoted`` lines, ``lines`` (null without quotes)."""
    text = F.coalesce("text", F.lit(""))
    # Few messages quote: the others keep their text as it is, and their lines are not looked at.
    quotes = text.rlike(r"(?:^|\n)[ \t]*>")
    base = messages.select(
        F.monotonically_increasing_id().alias("row"), "conv_id", F.col("turn").cast("long").alias("turn"), "role", text.alias("_text"),
        F.when(quotes, _lines(text)).alias("lines"),
    )
    own = F.filter("lines", lambda x: (x["level"] == 0) & ~x["introduces"])
    plain = F.trim(F.regexp_replace(F.array_join(F.transform(own, lambda x: x["body"]), "\n"), r"\n{3,}", "\n\n"), F.lit(" \n\t\r"))
    n_quoted = F.size(F.filter("lines", lambda x: x["level"] > 0)).cast("long")
    return base.select(
        "row", "conv_id", "turn", "role", F.when(F.col("lines").isNull(), F.col("_text")).otherwise(plain).alias("text"),
        F.when(F.col("lines").isNull(), F.lit(0).cast("long")).otherwise(n_quoted).alias("n_quoted"), "lines",
    )


def _hashed(df: DataFrame, *kept: str) -> DataFrame:
    """One row for each distinct normalised ``passage`` with text, with its hash."""
    plain = df.withColumn("passage", normalised(F.col("passage"))).filter("passage <> ''")
    return plain.withColumn("hash", F.xxhash64("passage")).select(*kept, "hash", "passage").distinct()


def quoted_passages(messages: DataFrame) -> DataFrame:
    """Runs of quoted lines of one level, and their single lines, of every message."""
    lines = messages.filter("lines IS NOT NULL").select("row", "conv_id", "turn", F.posexplode("lines").alias("at", "line"))
    lines = lines.select("row", "conv_id", "turn", "at", "line.level", "line.body").filter("level > 0")
    # Lines of a run have one difference between their place in the message and among the lines of their level.
    run = F.col("at") - F.row_number().over(W.partitionBy("row", "level").orderBy("at"))
    ordered = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "body"))), lambda x: x["body"]), " ")
    runs = lines.withColumn("run", run).groupBy("row", "conv_id", "turn", "level", "run").agg(ordered.alias("passage"))
    found = runs.select("row", "conv_id", "turn", "passage", F.lit(None).cast("long").alias("of"))
    found = found.unionByName(lines.select("row", "conv_id", "turn", F.col("body").alias("passage"), F.lit(None).cast("long").alias("of")))
    parts = runs.filter(F.col("passage").rlike(_SENTENCES)).select(
        "row", "conv_id", "turn", F.explode(F.split("passage", _SENTENCES)).alias("passage"), F.xxhash64(normalised(F.col("passage"))).alias("of")
    )
    return _hashed(found.unionByName(parts), "row", "conv_id", "turn", "of")


def own_passages(messages: DataFrame) -> DataFrame:
    """The unquoted text of every message, its paragraphs, its lines and their sentences."""
    lines = F.split("text", "\n")
    sentences = F.flatten(F.transform(lines, lambda line: F.split(line, _SENTENCES)))
    each = F.array_distinct(F.concat(F.array("text"), F.split("text", r"\n\s*\n"), lines, sentences))
    return _hashed(messages.select("conv_id", "turn", F.explode(each).alias("passage")), "conv_id", "turn")


def contained_passages(messages: DataFrame, quoted: DataFrame) -> DataFrame:
    """Runs of words of the unquoted text of every message that a quoted passage of its conversation consists of."""
    n = F.size(F.split("passage", " "))
    size = F.coalesce(*[F.when(n >= k, k) for k in _FIRST_WORDS])
    wanted = quoted.select("conv_id", size.alias("size"), F.xxhash64(F.array_join(F.slice(F.split("passage", " "), 1, size), " ")).alias("first"), n.alias("n")).distinct()
    worded = messages.select("row", "conv_id", "turn", F.split(normalised(F.col("text")), " ").alias("words"))
    places = worded.select("row", "conv_id", "words", F.explode(F.array(*map(F.lit, _FIRST_WORDS))).alias("size")).filter(F.size("words") >= F.col("size"))
    firsts = F.transform(F.sequence(F.lit(1), F.size("words") - F.col("size") + 1), lambda i: F.xxhash64(F.array_join(F.slice("words", i, F.col("size")), " ")))
    met = places.select("row", "conv_id", "size", F.posexplode(firsts).alias("at", "first")).join(wanted, ["conv_id", "size", "first"])
    spans = met.groupBy("row").agg(F.collect_set(F.struct("at", "n")).alias("spans"))
    fitting = F.filter("spans", lambda x: x["at"] + x["n"] <= F.size("words"))
    passages = F.array_distinct(F.transform(fitting, lambda x: F.array_join(F.slice("words", x["at"] + 1, x["n"]), " ")))
    return _hashed(worded.join(spans, "row").select("conv_id", "turn", F.explode(passages).alias("passage")), "conv_id", "turn")


def latest_before(points: DataFrame, keys: list[str], counts: Column, name: str) -> DataFrame:
    """``points`` with the latest earlier ``turn`` of a row of the same keys for which ``counts`` holds."""
    marked = points.withColumn("_stretch", F.floor(F.col("turn") / STRETCH)).withColumn("_turn", F.when(counts, F.col("turn")))
    inside = W.partitionBy(*keys, "_stretch").orderBy("turn").rangeBetween(W.unboundedPreceding, -1)
    per_stretch = marked.groupBy(*keys, "_stretch").agg(F.max("_turn").alias("_last"))
    earlier = W.partitionBy(*keys).orderBy("_stretch").rowsBetween(W.unboundedPreceding, -1)
    before = per_stretch.select(*keys, "_stretch", F.max("_last").over(earlier).alias("_before"))
    found = marked.withColumn("_inside", F.max("_turn").over(inside)).join(before, [*keys, "_stretch"])
    return found.withColumn(name, F.coalesce("_inside", "_before")).drop("_stretch", "_turn", "_inside", "_before")


def links(messages: DataFrame) -> DataFrame:
    """``row`` of each message that quotes an earlier one of its conversation, and the turn it ``quotes``.

    Of several originals the one that most characters come from counts, then the latest. A passage that stands in several
    earlier messages is taken from the latest of them, those first in which it is a text, paragraph, line or sentence.
    Sentences of a run count where the run as a whole is not found.
    """
    quoted = materialise(quoted_passages(messages).filter("conv_id IS NOT NULL AND turn IS NOT NULL"), "quoted")
    quoting = quoted.select("conv_id").distinct()
    others = messages.filter("turn IS NOT NULL").join(quoting, "conv_id", "left_semi")
    whole = own_passages(others).withColumn("own", F.lit(2))
    points = quoted.withColumn("own", F.lit(0)).unionByName(whole, allowMissingColumns=True)
    points = points.unionByName(contained_passages(others, quoted).withColumn("own", F.lit(1)), allowMissingColumns=True)
    keys = ["conv_id", "hash", "passage"]
    met = latest_before(latest_before(points, keys, F.col("own") == 2, "as_whole"), keys, F.col("own") == 1, "inside")
    met = met.withColumn("quotes", F.coalesce("as_whole", "inside")).filter("own = 0 AND quotes IS NOT NULL").select("row", "of", "hash", "passage", "quotes")
    met = materialise(met, "met")
    found = met.filter("of IS NULL").select("row", F.col("hash").alias("of")).distinct()
    counted = met.filter("of IS NULL").unionByName(met.filter("of IS NOT NULL").join(found, ["row", "of"], "left_anti"))
    per_original = counted.select("row", "quotes", "passage").distinct().groupBy("row", "quotes").agg(F.sum(F.length("passage")).alias("chars"))
    return per_original.groupBy("row").agg(F.max(F.struct("chars", "quotes"))["quotes"].alias("quotes"))


def conversations(messages: DataFrame) -> DataFrame:
    """Every row of ``messages`` (a stored table; ``conv_id``, ``turn``, ``role``, ``text``) as a message without quotations:
    ``conv_id``, ``turn``, ``role``, ``text``, ``n_quoted`` lines, ``reply_to`` (turn), ``by_quote`` (whether a quotation says
    so), ``position`` (from 1) and ``chat`` (role and text as one string).

    Null texts are empty, null roles "unknown". Messages without a conversation stand alone: position 1, no reply. Those
    without a turn come first, reply to nothing and are never quoted. Rows with one turn are ordered by role and text and
    reply to an earlier turn, not to each other.
    """
    read = parsed(messages)
    told = read.join(links(read), "row", "left")
    keyed = told.filter("conv_id IS NOT NULL")
    # Rows without a turn have a stretch of their own, before all others; the rest keep their order.
    placed = keyed.withColumn("stretch", F.coalesce(F.floor(F.col("turn") / STRETCH), F.lit(-(1 << 62))))
    inside = W.partitionBy("conv_id", "stretch").orderBy(F.col("turn").asc_nulls_first(), "role", "text", "row")
    per_stretch = placed.groupBy("conv_id", "stretch").agg(F.count("*").alias("n"), F.max("turn").alias("last"))
    earlier = W.partitionBy("conv_id").orderBy("stretch").rowsBetween(W.unboundedPreceding, -1)
    before = per_stretch.select(
        "conv_id", "stretch", F.coalesce(F.sum("n").over(earlier), F.lit(0).cast("long")).alias("n_before"), F.max("last").over(earlier).alias("last_before")
    )
    previous = F.max("turn").over(W.partitionBy("conv_id", "stretch").orderBy(F.col("turn").asc_nulls_first()).rangeBetween(W.unboundedPreceding, -1))
    numbered = (
        placed.withColumn("in_stretch", F.row_number().over(inside))
        .withColumn("previous", F.when(F.col("turn").isNotNull(), previous))
        .join(before, ["conv_id", "stretch"])
        .withColumn("position", F.col("n_before") + F.col("in_stretch"))
        .withColumn("previous", F.when(F.col("turn").isNotNull(), F.coalesce("previous", "last_before")))
    )
    alone = told.filter("conv_id IS NULL").withColumn("position", F.lit(1).cast("long")).withColumn("previous", F.lit(None).cast("long"))
    columns = ["conv_id", "turn", "role", "text", "n_quoted", "quotes", "previous", "position"]
    role = F.coalesce("role", F.lit("unknown"))
    return (
        numbered.select(*columns)
        .unionByName(alone.select(*columns))
        .select(
            "conv_id", "turn", role.alias("role"), "text", "n_quoted", F.coalesce("quotes", "previous").alias("reply_to"),
            F.col("quotes").isNotNull().alias("by_quote"), "position", F.concat(F.lit("<|"), role, F.lit("|>\n"), F.col("text")).alias("chat"),
        )
    )
