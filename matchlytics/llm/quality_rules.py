"""Quality rules from Spark's own functions alone: text statistics and lines that many documents of a host share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from matchlytics.llm.common import SPACE, fresh, stored

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, f"{SPACE}+"), "")


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed.

    Windows of five words are compared by a 64-bit hash within one text. Null counts as an empty text.
    """
    names = docs.columns
    w, win, by_hash = (fresh(n, names) for n in ("_words", "_windows", "_by_hash"))
    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = docs.withColumns(
        {
            "word_chars": F.length(F.translate(t, " \t\n\x0b\x0c\r", "")).cast("long"),
            "n_symbols": (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long"),
            "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
            w: _words(t),
        }
    )
    df = df.withColumns(
        {
            "n_words": F.size(w).cast("long"),
            win: F.when(F.size(w) >= 5, F.transform(F.sequence(F.lit(0), F.size(w) - 5), lambda i: F.xxhash64(*(F.col(w)[i + k] for k in range(5))))),
        }
    ).drop(w)
    # Only texts with a window found twice need the windows sorted; equal ones are then neighbours.
    repeats = F.size(F.array_distinct(win)) < F.size(win)
    df = df.withColumn(by_hash, F.when(repeats, F.sort_array(F.transform(win, lambda h, i: F.struct(h.alias("h"), i.alias("i")))))).drop(win)

    def same(k: Column, other: Column) -> Column:
        return F.get(F.col(by_hash), other)["h"] == F.get(F.col(by_hash), k)["h"]

    found = F.filter(by_hash, lambda x, k: F.coalesce(same(k, k - 1), F.lit(False)) | F.coalesce(same(k, k + 1), F.lit(False)))
    starts = F.sort_array(F.transform(found, lambda x: x["i"]))
    covered = F.aggregate(
        starts,
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda seen, i: F.struct((seen["n"] + i + 5 - F.greatest(i, seen["end"])).alias("n"), (i + 5).alias("end")),
        lambda seen: seen["n"],
    )
    df = df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop(by_hash)
    return df.withColumn("base_failed", (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20))


def _normal(line: Column) -> Column:
    """Lower case, white space and digits as one space."""
    return F.trim(F.regexp_replace(F.lower(line), r"[\x20\x09-\x0D0-9]+", " "))


def _line_key(line: Column, host: Column) -> Column:
    """Hash of host and normalised line."""
    return F.xxhash64(host, _normal(line))


STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def verdicts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source", min_docs: int = 20, max_share: float = 0.03, max_removed: float = 0.7, max_docs: int = 200, long_line: int = 5) -> DataFrame:
    """For each row: ``_id``, ``_copy`` (hash of the text), the statistics, ``n_lines_removed``, ``chars_removed``, ``kept`` and
    ``_keys`` of the lines to remove. See ``quality_rules``.

    The statistics are written before they are used: a filter pushed into them would work them out again for each word.
    """
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"), F.coalesce(F.col(host).cast("string"), F.lit("\0")).alias("_host"))
    split = F.filter(F.split(F.coalesce("_text", F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    keys = rows.select(F.explode(F.array_distinct(F.transform(split, lambda x: _line_key(x, F.col("_host"))))).alias("key"))
    often = stored(keys.groupBy("key").count().where(F.col("count") > min_docs).select("key"))

    lines = rows.select(
        "_id",
        F.xxhash64("_host").alias("host"),
        F.xxhash64("_text").alias("copy"),
        F.explode(F.transform(split, lambda x: F.struct(_line_key(x, F.col("_host")).alias("key"), F.length(x).alias("chars"), x.alias("line")))).alias("line"),
    ).select("_id", "host", "copy", "line.*")
    held = lines.join(often, "key").withColumn("long", F.size(F.split(_normal(F.col("line")), " ")) >= long_line)
    held = stored(held.groupBy("_id", "copy", "key").agg(F.max("host").alias("host"), F.sum("chars").alias("chars"), F.count("*").alias("n"), F.max("long").alias("long")))
    documents = rows.select(F.xxhash64("_host").alias("host"), "_id", F.xxhash64("_text").alias("copy")).distinct()
    hosts = documents.groupBy("host").agg(F.count("*").alias("docs"))
    counted = held.groupBy("key").agg(F.max("host").alias("host"), F.count("*").alias("found"), F.min("copy").alias("a"), F.max("copy").alias("b"), F.min("_id").alias("first"), F.max("long").alias("long"))
    many = (F.col("found") > F.col("docs") * max_share) | (F.col("long") & (F.col("found") > max_docs))
    above = counted.join(hosts, "host").where((F.col("found") > min_docs) & many & (F.col("a") != F.col("b"))).select("key", "first")
    removed = (
        held.join(above, "key")
        .where(~F.col("_id").eqNullSafe(F.col("first")))
        .groupBy(F.col("_id").alias("id"), "copy")
        .agg(F.sum("n").alias("n_lines_removed"), F.sum("chars").alias("chars_removed"), F.collect_set("key").alias("_keys"))
    )
    own = with_statistics(rows, "_text").select("_id", F.xxhash64("_text").alias("_copy"), F.coalesce(F.length("_text"), F.lit(0)).alias("_size"), *STATISTICS)
    own = stored(own)
    df = own.join(removed, own["_id"].eqNullSafe(removed["id"]) & (own["_copy"] == removed["copy"]), "left")
    return df.select(
        "_id",
        "_copy",
        *STATISTICS,
        F.coalesce("n_lines_removed", F.lit(0)).cast("long").alias("n_lines_removed"),
        F.coalesce("chars_removed", F.lit(0)).cast("long").alias("chars_removed"),
        (~F.col("base_failed") & (F.coalesce("chars_removed", F.lit(0)) <= F.col("_size") * max_removed)).alias("kept"),
        "_keys",
    )


def quality_rules(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source", min_docs: int = 20, max_share: float = 0.03, max_removed: float = 0.7, max_docs: int = 200, long_line: int = 5) -> DataFrame:
    """Adds the statistics, ``n_lines_removed``, ``chars_removed``, ``kept`` and ``cleaned``.

    A line is above the limit if more than ``min_docs`` documents of its host and more than ``max_share`` of them hold
    it and these aren't all copies of one text. Lines of ``long_line`` words or more are so in more than ``max_docs`` documents too,
    whatever the host's size; short ones, common in clean documents, are not. Such lines are taken out of ``cleaned``, except in the document of the
    smallest id that has them. A document is rejected if it fails the base rules or if more than ``max_removed`` of its
    characters stood in such lines.

    Lines are counted in two passes: first all of them by an eight-byte hash, then the few that may be above the limit
    in full; a frequent line is combined before each shuffle. Rows of one id and text count as one document. Null texts
    are empty (and fail), a null host is a host. Existing columns of the added names are replaced.
    """
    docs = docs.drop(*(c for c in [*STATISTICS, "n_lines_removed", "chars_removed", "kept", "cleaned"] if c not in (doc_id, text, host)))
    found = verdicts(docs, doc_id, text, host, min_docs, max_share, max_removed, max_docs, long_line).dropDuplicates(["_id", "_copy"])
    own_id, copy, gone = (fresh(n, [*docs.columns, *found.columns, "cleaned"]) for n in ("_own_id", "_own_copy", "_own_keys"))
    found = found.withColumnsRenamed({"_id": own_id, "_copy": copy, "_keys": gone})
    df = docs.join(found, docs[doc_id].eqNullSafe(found[own_id]) & (F.xxhash64(docs[text]) == found[copy]))
    h = F.coalesce(F.col(host).cast("string"), F.lit("\0"))
    rest = F.array_join(F.filter(F.split(text, "\n"), lambda x: ~(x.rlike(r"[^\x20\x09-\x0D]") & F.array_contains(gone, _line_key(x, h)))), "\n")
    return df.withColumn("cleaned", F.when(F.col(gone).isNull(), F.col(text)).otherwise(rest)).drop(own_id, copy, gone)
