"""Quotation linking, in DataFrame functions only: conversations rebuilt from what messages quote.

A line's quote level is the number of ``>`` signs before its text. The lines of a message fall into passages, runs
of one level. The message's own passages are level 0; a passage quoted at level k repeats words of an ancestor
k steps up. Passages and lines are normalised (letters and digits in lower case, single blanks) and hashed; each
hash belongs to the earliest message of its scope that wrote it, so a join on the hash gives one origin however
often a text was written or quoted. The parent is the origin of the lowest quoted level that has one earlier than
the message itself; among several origins the one with the most quoted letters, then the latest.

Roots and depths come from pointer jumping, whose rounds grow with the logarithm of the longest chain, each written
to the shared folder. Output is ordered by conversation, depth and time, over many partitions.

Messages without text have no passages and stay single; so do those whose time is null, as nothing is known to
be earlier. Of rows that repeat an id the one least by time, scope and body is taken (nulls first). Messages without
id are kept one by one, each a conversation of its own without id, and are nobody's origin. Quotes that match nothing
link nothing, and are still removed. Of equal times and ids nothing is earlier. Empty tables give no rows; other columns,
whatever their names, are not read, and very long messages are parsed whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirgate.llm.common import stage

MOST_ROUNDS = 60
_MARKS = "^(?:[ \\t]{0,3}>)+"


def _normal(text: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(text), "[^\\p{L}\\p{N}]+", " "))


def parse(messages: DataFrame) -> DataFrame:
    """id, scope, sent, own (text without quotes) and passages: level, hash and size of each normalised run and line."""
    unmarked = F.split(F.replace(F.coalesce("body", F.lit("")), F.lit("\r"), F.lit("")), "\n")
    marked = F.transform(
        unmarked,
        lambda x: F.struct(F.when(F.contains(x, F.lit(">")), F.regexp_extract(x, _MARKS, 0)).otherwise("").alias("marks"), x.alias("line")),
    )
    # One blank after the marks belongs to them.
    lines = """transform(marked, x -> struct(
        length(x.marks) - length(replace(x.marks, '>', '')) AS level,
        substring(x.line, length(x.marks) + if(substring(x.line, length(x.marks) + 1, 1) IN (' ', '\t'), 2, 1)) AS text))"""
    # A run's normal form is that of its lines, those without any letter or digit left out.
    normal = F.transform("lines", lambda x: F.struct(x["level"].alias("level"), _normal(x["text"]).alias("text")))
    begun = "filter(sequence(0, size(lines) - 1), i -> i = 0 OR get(lines, i).level <> get(lines, i - 1).level)"
    runs = """transform(starts, (s, k) -> struct(get(lines, s).level AS level, array_join(
        filter(transform(slice(normal, s + 1, coalesce(get(starts, k + 1), size(lines)) - s), x -> x.text), t -> t <> ''), ' ') AS text))"""
    own = """array_join(transform(filter(sequence(0, size(starts) - 1), k -> get(lines, get(starts, k)).level = 0),
        k -> btrim(array_join(transform(slice(lines, get(starts, k) + 1, coalesce(get(starts, k + 1), size(lines)) - get(starts, k)),
            x -> x.text), '\n'), ' \t\n')), '\n')"""
    parsed = messages.withColumn("marked", marked).withColumn("lines", F.expr(lines)).withColumn("normal", normal)
    parsed = parsed.withColumn("starts", F.expr(begun)).withColumn("runs", F.expr(runs)).withColumn("own", F.expr(own))
    hashed = F.transform(
        F.filter(F.concat("runs", "normal"), lambda p: p["text"] != ""),
        lambda p: F.struct(p["level"].alias("level"), F.md5(p["text"]).alias("hash"), F.length(p["text"]).alias("size")),
    )
    passages = F.array_distinct(hashed)
    return parsed.select("id", "scope", "sent", F.btrim("own", F.lit(" \t\n")).alias("own"), passages.alias("passages"))


def link(parsed: DataFrame) -> DataFrame:
    """id, parent of the messages with a known parent."""
    passages = parsed.where("id is not null and sent is not null").select("id", "scope", "sent", F.explode("passages").alias("p")).select(
        "id", "scope", "sent", "p.level", "p.hash", "p.size"
    )
    origins = passages.where("level = 0").groupBy("scope", "hash").agg(F.min(F.struct("sent", "id")).alias("origin"))
    origins = origins.select(F.col("scope").alias("in_scope"), F.col("hash").alias("written"), "origin")
    met = passages.where("level > 0").join(
        origins, F.col("scope").eqNullSafe(F.col("in_scope")) & (F.col("hash") == F.col("written"))
    )
    known = met.where(F.col("origin.sent") < F.col("sent"))
    weighed = known.groupBy("id", "level", "origin").agg(F.sum("size").alias("weight"))
    best = F.max_by("origin", F.struct((-F.col("level")).alias("l"), "weight", "origin"))
    return weighed.groupBy("id").agg(best.alias("origin")).select("id", F.col("origin.id").alias("parent"))


def roots(links: DataFrame) -> DataFrame:
    """id, root, depth of every id with a parent. Parents are earlier, so there are no cycles.

    Each round joins only ids whose root is not known yet, so one long chain does not move the others again.
    """
    whole = "id", "root", "depth", "done"
    open_ = links.select("id", F.col("parent").alias("root"), F.lit(1).cast("bigint").alias("depth"), F.lit(False).alias("done"))
    open_, settled = stage(open_, "roots"), []
    for _ in range(MOST_ROUNDS):
        every = reduce(DataFrame.union, [open_, *settled])
        up = every.select(
            F.col("id").alias("root"), F.col("root").alias("next"), F.col("depth").alias("more"), F.col("done").alias("known")
        )
        joined = open_.join(up, "root", "left").select(
            "id",
            F.coalesce("next", "root").alias("root"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            F.coalesce("known", F.lit(True)).alias("done"),
        )
        round_ = stage(joined.select(*whole), "roots")
        settled.append(round_.where("done"))
        open_ = round_.where("not done")
        if open_.isEmpty():
            return reduce(DataFrame.union, settled).drop("done")
    raise RuntimeError("reply chains did not settle")


def conversations(messages: DataFrame) -> DataFrame:
    """``messages`` (id, scope, sent, body) as conversation_id, depth, sent, id, parent, text, in reply order.

    ``scope`` limits where quotes are looked up, a list or a mailbox; null is a scope of its own.
    """
    wanted = messages.select("id", "scope", "sent", "body")
    first = F.min(F.struct("sent", "scope", "body")).alias("first")
    once = wanted.where("id is not null").groupBy("id").agg(first).select("id", "first.scope", "first.sent", "first.body")
    parsed = stage(parse(once.unionByName(wanted.where("id is null"))), "parsed")
    links = stage(link(parsed), "links")
    placed = parsed.select("id", "sent", F.col("own").alias("text")).join(links, "id", "left").join(roots(links), "id", "left")
    out = placed.select(
        F.coalesce("root", "id").alias("conversation_id"),
        F.coalesce("depth", F.lit(0).cast("bigint")).alias("depth"),
        "sent",
        "id",
        "parent",
        "text",
    )
    order = ["conversation_id", "depth", "sent", "id"]
    return out.repartitionByRange(*order).sortWithinPartitions(*order)


def quoting_replies(conversations_: DataFrame) -> DataFrame:
    """The turns of a conversation table as messages in which every turn quotes the one before, and the one before that.

    A turn whose predecessor is missing quotes nothing. Turns meet by equality joins, so a long conversation is
    not gathered anywhere. Turns without conversation or number have no place and are left out; of several texts
    of one turn the least is taken, null as empty.
    """
    placed = conversations_.where("conv_id is not null and turn is not null")
    turns = placed.groupBy("conv_id", "turn").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))

    def before(k: int) -> DataFrame:
        return turns.select("conv_id", (F.col("turn") + k).alias("turn"), F.col("text").alias(f"text_{k}"))

    def quoted(name: str, marks: str) -> Column:
        return F.array_join(F.transform(F.split(name, "\n"), lambda x: F.concat(F.lit(marks), x)), "\n")

    met = turns.join(before(1), ["conv_id", "turn"], "left").join(before(2), ["conv_id", "turn"], "left")
    chain = F.when(F.col("text_1").isNotNull(), quoted("text_2", "> > "))
    body = F.concat_ws("\n", chain, quoted("text_1", "> "), F.when(F.col("text_1").isNotNull(), F.lit("")), F.col("text"))
    return met.select(
        F.concat_ws(".", "conv_id", "turn").alias("id"), F.col("conv_id").alias("scope"), F.col("turn").alias("sent"), body.alias("body")
    )
