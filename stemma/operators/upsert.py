"""Keyed corrections, duplicate merges and guarded overwrites as joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stemma.operators.ordered import number_within


def last_per_key(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``key, *columns``: one row per key, the last by ``ord``.

    Without a column ``ord``, or among rows equal in it, the row with the
    greatest values in the order of ``columns`` is taken; nulls come first.
    Combined in each task before rows travel, so a hot key is one row from each.
    """
    order = ["ord"] if "ord" in rows.columns else []
    last = rows.groupBy(key).agg(F.max(F.struct(*order, *columns)).alias("_last"))
    return last.select(key, *[F.col(f"_last.{c}").alias(c) for c in columns])


def merge_duplicates(pieces: DataFrame, rules: DataFrame) -> DataFrame:
    """Drop the listed duplicates and retitle the rows kept.

    ``pieces(cahier, piece_slug, title, …)``; ``rules(cahier, keep_slug,
    drop_slug, new_title)``. Both sides are keyed, so a hot key is a hot row at
    most in the rules.
    """
    drops = rules.select("cahier", F.col("drop_slug").alias("piece_slug")).distinct()
    titles = rules.groupBy("cahier", F.col("keep_slug").alias("piece_slug")).agg(
        F.max("new_title").alias("_title")
    )
    kept = pieces.join(drops, ["cahier", "piece_slug"], "left_anti")
    return kept.join(titles, ["cahier", "piece_slug"], "left").withColumn(
        "title", F.coalesce("_title", "title")
    ).select(*pieces.columns)


def drop_documents(docs: DataFrame, rules: DataFrame) -> DataFrame:
    """Documents of the dropped duplicates go, in every language."""
    drops = rules.select("cahier", F.col("drop_slug").alias("piece_slug")).distinct()
    return docs.join(drops, ["cahier", "piece_slug"], "left_anti")


def apply_corrections(pieces: DataFrame, rules: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Apply ``set``, ``replace`` and ``append`` rules to pieces, in order.

    ``pieces(cahier, pos, piece_slug, title, author)``; ``rules(cahier,
    piece_slug, field, from, to, op)`` and optionally ``ord``, the order in which
    rules apply (rules without one last, ties by their values). ``set`` gives
    ``field`` the value ``to``; ``replace`` swaps ``from`` for ``to`` inside it.
    Both hold for every piece of the issue when ``piece_slug`` is null, and only for
    pieces whose author is ``author`` when there is such a column and it is not
    null. ``append`` adds the piece with title ``to`` and author ``from`` after the
    last one, unless the slug exists.

    Returns the corrected pieces and the log ``(cahier, piece_slug, field, old, new)``.
    """
    given = rules
    for column, kind in (("ord", "long"), ("author", "string")):
        if column not in rules.columns:
            given = given.withColumn(column, F.lit(None).cast(kind))
    edits = given.filter(F.col("op").isin("set", "replace")).withColumn("rule", F.struct(
        F.coalesce(F.col("ord").cast("long"), F.lit(2**62)).alias("ord"), "op", "field", "from", "to", "author"))
    # one row per piece and one per issue, each with all its rules
    own = edits.filter("piece_slug is not null").groupBy("cahier", "piece_slug").agg(F.collect_list("rule").alias("_own"))
    shared = edits.filter("piece_slug is null").groupBy("cahier").agg(F.collect_list("rule").alias("_shared"))
    none = F.array().cast(f"array<{edits.schema['rule'].dataType.simpleString()}>")
    out = pieces.join(own, ["cahier", "piece_slug"], "left").join(shared, "cahier", "left")
    out = out.withColumn("_rules", F.array_sort(F.concat(F.coalesce("_own", none), F.coalesce("_shared", none))))

    def apply(acc: Column, rule: Column) -> Column:
        meant = rule["author"].isNull() | rule["author"].eqNullSafe(F.col("_old_author"))

        def new(field: str) -> Column:
            value = F.when(rule["op"] == "set", rule["to"]).otherwise(F.replace(acc[field], rule["from"], rule["to"]))
            return F.when(meant & (rule["field"] == field), value).otherwise(acc[field]).alias(field)

        return F.struct(new("title"), new("author"))

    out = out.withColumn("_old_title", F.col("title")).withColumn("_old_author", F.col("author"))
    out = out.withColumn("_new", F.aggregate("_rules", F.struct("title", "author"), apply))
    out = out.withColumn("title", F.col("_new.title")).withColumn("author", F.col("_new.author"))
    changed = F.filter(
        F.array(*[
            F.when(~F.col(f).eqNullSafe(F.col(f"_old_{f}")), F.struct(
                F.lit(f).alias("field"), F.col(f"_old_{f}").alias("old"), F.col(f).alias("new")
            ))
            for f in ("title", "author")
        ]),
        lambda c: c.isNotNull(),
    )
    log = out.select("cahier", "piece_slug", F.explode(changed).alias("_c")).select(
        "cahier", "piece_slug", "_c.field", "_c.old", "_c.new"
    )
    adds = rules.filter(F.col("op") == "append").join(
        pieces.select("cahier", "piece_slug"), ["cahier", "piece_slug"], "left_anti"
    )
    ends = pieces.groupBy("cahier").agg(F.max("pos").alias("_end"))
    adds = number_within(adds.dropDuplicates(["cahier", "piece_slug"]), ["cahier"], ["piece_slug"], "_turn")
    adds = adds.join(ends, "cahier", "left").select(
        "cahier", "piece_slug", (F.coalesce("_end", F.lit(-1)) + F.col("_turn")).alias("pos"),
        F.col("to").alias("title"), F.col("from").alias("author"),
    )
    log = log.unionByName(adds.select(
        "cahier", "piece_slug", F.lit("piece").alias("field"), F.lit(None).cast("string").alias("old"),
        F.col("title").alias("new"),
    ))
    fixed = out.select("cahier", "piece_slug", "pos", "title", "author").unionByName(adds)
    return fixed, log


def insert_absent(table: DataFrame, rows: DataFrame, key: list[str]) -> DataFrame:
    """Add the rows whose key the table does not hold yet."""
    return table.unionByName(rows.join(table.select(*key).distinct(), key, "left_anti"), allowMissingColumns=True)


def size_guard(old_words: Column, new_words: Column, exempt: Column) -> Column:
    """A long document may not shrink below 30 percent, unless exempt."""
    return ~exempt & (old_words > 1000) & (new_words < old_words * 0.3)
