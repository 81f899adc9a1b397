"""Line dedup with a log-template tree of fixed depth.

A line descends by its number of tokens and its first ``LEADING`` tokens to a leaf; tokens that hold a digit are
variable fields (``<*>``) from the start. Inside a group, the leaf first, the distinct lines vote per position: a token that more
than half of them share belongs to the group's template, any other position is a variable field. A line fits the template if at least
``FIT`` of its tokens below the leading ones are those of the template. Lines that do not fit descend further: at up to ``BANDS``
places spread over these tokens, those that share the two tokens there are a group and vote again. As a family of lines
has most of its tokens in common, some of the places hold two of them, and there its lines meet without those of other families,
however many a leaf has. A line that fits nowhere is a template of its own, as are lines too short for a variable field. A
template found in two or more documents is recurring: its lines stay in the first document (lowest doc_id, then text
hash; null ids last) and are dropped from all others.

The votes need the tokens only of leaves with several distinct lines, and of each kind of line only one, so only
those documents are read again and only those lines are shuffled. Everything else moves hashes. A template that a third of all lines share is folded before each shuffle, and the join that marks its
lines can be split by the skew rule. Nothing is gathered per template; arrays are bounded by one line or document.

Defined cases: null text stays null; blank lines always stay; a line of variable fields alone is compared by its own
tokens, as its template would say nothing; repeated lines inside one document stay together; rows equal in doc_id and text
are one document; very long texts and lines are read whole; if tokens tie in a vote, neither has more than half; a text of which no line is left becomes empty, the document
itself stays; empty tables give empty tables; other columns pass through.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slicemill.llm.common import keyed, packed, same_document, written

LEADING, FIT, BANDS = 3, 0.8, 6
LEAST_TAIL = 5  # tokens below the leading ones of which FIT is fewer than all
FIELD = "<*>"
SPACES = r"[\x09-\x0D\x20]+"
BROADCAST_LINES = 500_000  # 20 bytes each, and as much for each document


def masked(line: Column) -> Column:
    """Tokens with one space between them; those with a digit are variable. Regular expressions run only where a plain
    search has found something for them."""
    def any_of(c, parts):
        return reduce(lambda x, y: x | y, [F.contains(c, F.lit(p)) for p in parts])

    squeezed = F.trim(F.when(any_of(line, ["  ", "\t", "\r", "\x0b", "\x0c"]), F.regexp_replace(line, SPACES, " ")).otherwise(line))
    return F.when(any_of(line, "0123456789"), F.regexp_replace(squeezed, r"(?<![^ ])[^ 0-9]*+[0-9][^ ]*+", FIELD)).otherwise(squeezed)


def lines(docs: DataFrame) -> DataFrame:
    """doc_id, th, line_no, n (tokens), leaf, mh (hash of the masked line) of every line that can be a template."""
    rows = keyed(docs).select("doc_id", "th", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    # blank lines are told by the line itself: a condition on the masked one would mask it twice
    rows = rows.where(F.btrim("line", F.lit(" \t\r\x0b\x0c")) != "").select("doc_id", "th", "line_no", "line", masked(F.col("line")).alias("masked"))
    # all tokens are counted, but only the leading ones are looked at
    n = F.length("masked") - F.length(F.replace("masked", F.lit(" "), F.lit(""))) + 1
    only_fields = F.startswith("masked", F.lit(FIELD)) & (F.replace(F.replace("masked", F.lit(FIELD), F.lit("")), F.lit(" "), F.lit("")) == "")
    own = F.when(only_fields, F.concat(F.lit(FIELD), F.regexp_replace(F.trim(F.regexp_replace("line", SPACES, " ")), SPACES, " "))).otherwise(F.col("masked"))
    return rows.select("doc_id", "th", "line_no", n.alias("n"), F.xxhash64(n, F.substring_index("masked", " ", LEADING)).alias("leaf"), F.xxhash64(own).alias("mh"))


def places(tokens: Column) -> Column:
    """Where the tokens below the leading ones are compared in pairs."""
    last = F.size(tokens) - 1
    return F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda j: F.floor(j * last / BANDS).cast("int")))


def voters(docs: DataFrame, every: DataFrame) -> DataFrame:
    """leaf, mh and hashed tokens below the leading ones of one line of each kind, in leaves with several kinds."""
    kinds = every.where(F.col("n") >= LEADING + LEAST_TAIL).groupBy("leaf", "mh").agg(F.min(F.struct("doc_id", "th", "line_no")).alias("at"))
    kinds = written(kinds.select("leaf", "mh", "at.*"), "kinds")
    several = kinds.groupBy("leaf").agg(F.count("*").alias("m")).where("m > 1").select("leaf")
    wanted = written(kinds.join(several, "leaf").groupBy("doc_id", "th").agg(F.collect_list(F.struct("line_no", "leaf", "mh")).alias("wanted")), "voting")
    texts = keyed(docs)
    few = F.broadcast(wanted) if wanted.agg(F.coalesce(F.sum(F.size("wanted")), F.lit(0))).first()[0] <= BROADCAST_LINES else wanted
    found = texts.join(few, same_document(texts, few)).select(F.split("text", "\n", -1).alias("all"), F.explode("wanted").alias("w"))
    found = found.select("w.leaf", "w.mh", masked(F.get("all", F.col("w.line_no"))).alias("masked")).dropDuplicates(["leaf", "mh"])
    tokens = F.transform(F.slice(F.split("masked", " "), F.lit(LEADING + 1), F.lit(1 << 30)), lambda t: F.xxhash64(t))
    return written(found.select("leaf", "mh", tokens.alias("tokens")), "voters")


def fits(members: DataFrame) -> DataFrame:
    """(mh, group) of the members (mh, tokens, group) that fit the template of their group, which has others."""
    several = members.groupBy("group").agg(F.count("*").alias("m")).where("m > 1")
    members = written(members.join(several, "group"), "members")
    votes = members.select("group", "m", F.posexplode("tokens").alias("at", "token")).groupBy("group", "m", "at", "token").agg(F.count("*").alias("c"))
    best = votes.groupBy("group", "at").agg(F.max(F.when(2 * F.col("c") > F.col("m"), F.col("token"))).alias("shared"))
    best = best.groupBy("group").agg(F.array_sort(F.collect_list(F.struct("at", "shared"))).alias("best"))
    agree = F.size(F.filter(F.zip_with("tokens", "best", lambda a, b: a == b["shared"]), lambda same: same))
    return written(members.join(best, "group").where(agree >= F.lit(FIT) * F.size("tokens")).select("mh", "group"), "fits")


def fitting(docs: DataFrame, every: DataFrame) -> DataFrame:
    """(mh, templates) of the lines that fit the template of a group; ``every`` is the stored form of ``lines``."""
    t = F.col("tokens")
    asked = voters(docs, every)
    whole = fits(asked.select("mh", "tokens", F.col("leaf").alias("group")))
    pairs = F.transform(places(t), lambda p: F.xxhash64("leaf", p, F.get(t, p), F.get(t, p + 1)))
    below = fits(asked.join(whole, "mh", "left_anti").select("mh", "tokens", F.explode(pairs).alias("group")))
    return written(whole.unionByName(below).groupBy("mh").agg(F.collect_list("group").alias("templates")), "fitting")


def recurring_lines(docs: DataFrame, min_docs: int = 2) -> DataFrame:
    """doc_id, th, dropped (sorted line numbers) of documents that lose lines."""
    every = written(lines(docs), "lines")
    fit = fitting(docs, every)
    few = F.broadcast(fit) if fit.count() <= BROADCAST_LINES // 5 else fit
    long = every.where(F.col("n") >= LEADING + LEAST_TAIL).join(few, "mh", "left")
    long = long.select("doc_id", "th", "line_no", F.explode(F.coalesce("templates", F.array("mh"))).alias("template"))
    short = every.where(F.col("n") < LEADING + LEAST_TAIL).select("doc_id", "th", "line_no", F.col("mh").alias("template"))
    every = written(long.unionByName(short), "templates")
    holder = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th").alias("holder")
    held = every.select("template", holder)
    if min_docs == 2:  # the first and the last holder tell enough
        found = held.groupBy("template").agg(F.min("holder").alias("first"), F.max("holder").alias("last")).where(~F.col("first").eqNullSafe(F.col("last")))
    else:
        found = held.distinct().groupBy("template").agg(F.count("*").alias("docs"), F.min("holder").alias("first")).where(F.col("docs") >= min_docs)
    # stored, so that both sides of the join are dealt anew and a hot template can be split
    found = written(found.select("template", "first"), "recurring")
    rest = every.join(found, "template").where(~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("th") == F.col("first.th"))))
    return rest.groupBy("doc_id", "th").agg(F.array_sort(F.collect_set("line_no")).alias("dropped"))


def dedup_lines(docs: DataFrame, min_docs: int = 2, report: bool = False) -> DataFrame:
    """``docs`` without recurring lines. With ``report``: doc_id, n_lines, n_dropped and the text that is left."""
    gone = recurring_lines(docs, min_docs)
    p = packed(docs)
    j = p.join(gone, same_document(p, gone), "left").select("row", "dropped")
    all_lines = F.split(F.col("row.text"), "\n", -1)
    left = F.array_join(F.filter(all_lines, lambda x, i: ~F.array_contains("dropped", i)), "\n")
    j = j.withColumn("left", F.when(F.col("dropped").isNull(), F.col("row.text")).otherwise(left))
    if report:
        n = F.when(F.col("row.text").isNull(), 0).otherwise(F.size(all_lines))
        return j.select(F.col("row.doc_id").alias("doc_id"), n.cast("long").alias("n_lines"), F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"), F.col("left").alias("text"))
    cols = [F.col("left").alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns]
    return j.select(*cols)
