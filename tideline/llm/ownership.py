"""Secret scans judged by how many owners share a candidate.

Candidates are found with regular expressions in the JVM. Their hashes are counted over
the corpus by distinct repositories and owners: a value that many owners hold is a copied
example, one that few owners hold looks like a live credential.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import join_keys, keyed, text_key, text_of
from tideline.session import stored

# Fixed by the contract: the base kinds in their order. ``least`` is the shortest secret.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"  # the same matches as AKIA[A-Z0-9]+ of 16 or more characters
HEX = r"[0-9a-f]{32,}"  # the same matches as [0-9a-f]+ of 32 or more characters
BASE = ("assign", "access", "hex")
#: The method's own kind: opaque strings, spans only where few owners hold them.
OPAQUE = r"[A-Za-z0-9+/_-]{24,}={0,2}"
KINDS = (*BASE, "opaque")


def matches(text: Column, kind: str, pattern: str) -> Column:
    """Leftmost non-overlapping matches as structs (start, rank, end, value), in code points.

    Texts between matches and the matches themselves alternate, so their lengths add up
    to the places.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    rank = KINDS.index(kind)
    nothing = F.lit([]).cast("array<struct<start:int,rank:int,end:int,value:string>>")

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["gap"])
        end = start + F.length(pair["hit"])
        value = F.regexp_extract(pair["hit"], pattern, 2) if kind == "assign" else pair["hit"]
        one = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), value.alias("value"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(one)).alias("out"))

    pairs = F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda g, h: F.struct(g.alias("gap"), h.alias("hit")))
    start = F.struct(F.lit(0).alias("at"), nothing.alias("out"))
    folded = F.aggregate(pairs, start, step, lambda s: s["out"])
    return F.when(F.regexp_like(text, F.lit(pattern)), folded).otherwise(nothing)


def base_matches(text: Column) -> Column:
    """The base spans of a text, by start, then kind."""
    assign = F.filter(matches(text, "assign", ASSIGN), lambda m: F.length(m["value"]) >= 8)
    return F.array_sort(F.concat(assign, matches(text, "access", ACCESS), matches(text, "hex", HEX)))


def opaque_matches(text: Column) -> Column:
    """Long strings that mix letters and digits and use at least ten different characters."""
    def mixed(m):
        value = m["value"]
        kinds = F.size(F.array_distinct(F.split(value, "")))
        return F.regexp_like(value, F.lit("[0-9]")) & F.regexp_like(value, F.lit("[A-Za-z]")) & (kinds >= 10)

    return F.filter(matches(text, "opaque", OPAQUE), mixed)


def with_candidates(docs: DataFrame, owner: Column, repo: Column, keep: list[str]) -> DataFrame:
    """Stored: the kept columns, a row id, owner, repo, and the spans with hashed values.

    An opaque match that overlaps a base span is part of that span already.
    """
    text = text_of()
    spans = docs.select(
        *keep, owner.alias("_owner"), repo.alias("_repo"),
        base_matches(text).alias("_base"), opaque_matches(text).alias("_opaque"),
    ).withColumn(
        "_opaque",
        F.filter("_opaque", lambda o: ~F.exists("_base", lambda b: (b["start"] < o["end"]) & (o["start"] < b["end"]))),
    )

    def hashed(name):
        return F.transform(
            name,
            lambda m: F.struct(m["start"].alias("start"), m["rank"].alias("rank"), m["end"].alias("end"), F.sha2(m["value"], 256).alias("hash")),
        ).alias(name)

    return stored(
        spans.select(
            *keep, F.monotonically_increasing_id().alias("_row"), "_owner", "_repo", hashed("_base"), hashed("_opaque")
        ),
        "candidates",
    )


def ownership(found: DataFrame) -> DataFrame:
    """Per candidate hash: occurrences, distinct repositories and distinct owners.

    Occurrences are added up per (hash, owner, repo) on the map side first, so a value
    that fills a third of the corpus is a few rows per task before any shuffle.
    """
    each = found.select(
        "_owner", "_repo", F.explode(F.concat("_base", "_opaque")).alias("m")
    ).select("_owner", "_repo", F.col("m.hash").alias("hash"))
    places = each.groupBy("hash", "_owner", "_repo").agg(F.count(F.lit(1)).alias("n"))
    owners = places.groupBy("hash", "_owner").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("repos"))
    return owners.groupBy("hash").agg(
        F.sum("n").alias("occurrences"), F.sum("repos").alias("repos"), F.count(F.lit(1)).alias("owners")
    )


def judged(docs: DataFrame, owner: Column, repo: Column, keep: list[str], max_owners: int = 2) -> DataFrame:
    """Find and judge the secrets of every row.

    Returns ``keep``, n_assign, n_access, n_hex and the arrays base and spans, both of
    structs (start, rank, end, hash, occurrences, repos, owners, live) ordered by start, then kind. A
    candidate is live if at most ``max_owners`` owners hold its value, else a copied
    example. ``spans`` are all base spans and the live opaque ones.

    Null text is empty; a null owner or repository counts as one unnamed owner or
    repository; repeated rows are rows of their own. Very long texts cost one pass per
    kind. An empty table gives no rows.
    """
    found = with_candidates(docs, owner, repo, keep)
    each = found.select("_row", F.explode(F.concat("_base", "_opaque")).alias("m")).select("_row", "m.*")
    verdicts = (
        each.join(ownership(found), "hash")
        .select(
            "_row",
            F.struct("start", "rank", "end", "hash", "occurrences", "repos", "owners", (F.col("owners") <= max_owners).alias("live")).alias("m"),
        )
        .groupBy("_row")
        .agg(F.array_sort(F.collect_list("m")).alias("all"))
    )
    nothing = F.lit([]).cast(
        "array<struct<start:int,rank:int,end:int,hash:string,occurrences:bigint,repos:bigint,owners:bigint,live:boolean>>"
    )
    full = found.join(verdicts, "_row", "left").withColumn("all", F.coalesce("all", nothing))

    def count(rank):
        return F.size(F.filter("all", lambda m: m["rank"] == rank)).cast("long")

    opaque = KINDS.index("opaque")
    return full.select(
        *keep,
        *(count(i).alias(f"n_{kind}") for i, kind in enumerate(BASE)),
        F.filter("all", lambda m: m["rank"] < opaque).alias("base"),
        F.filter("all", lambda m: (m["rank"] < opaque) | m["live"]).alias("spans"),
        F.size("_opaque").cast("long").alias("n_opaque"),
    )


def span_text(spans: str) -> Column:
    """kind:start:end, joined by commas."""
    kinds = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(
        F.transform(spans, lambda m: F.concat_ws(":", F.element_at(kinds, m["rank"] + 1), m["start"], m["end"])), ","
    )


#: Most bytes of a document's row in the join of spans, and of each of its slim spans.
ROW_BYTES, SPAN_BYTES = 64, 40


def masked(text: Column, spans: Column, live: str = "<SECRET>", example: str = "<EXAMPLE_SECRET>") -> Column:
    """The text with every span replaced; overlapping spans are one, live if any of them is."""
    def merge(state, m):
        last = F.element_at(state, -1)
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], m["end"]).alias("end"), (last["live"] | m["live"]).alias("live"))
        one = F.struct(m["start"].alias("start"), m["end"].alias("end"), m["live"].alias("live"))
        head = F.slice(state, 1, F.greatest(F.size(state) - 1, F.lit(0)))
        return F.when(
            (F.size(state) > 0) & (m["start"] < F.try_element_at(state, F.lit(-1))["end"]), F.concat(head, F.array(joined))
        ).otherwise(F.concat(state, F.array(one)))

    nothing = F.lit([]).cast("array<struct<start:int,end:int,live:boolean>>")
    merged = F.aggregate(spans, nothing, merge)

    def put(state, m):
        piece = F.substring(text, state["at"] + 1, m["start"] - state["at"])
        mark = F.when(m["live"], F.lit(live)).otherwise(F.lit(example))
        return F.struct(m["end"].alias("at"), F.concat(state["out"], F.array(F.concat(piece, mark))).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit([]).cast("array<string>").alias("out"))
    done = F.aggregate(merged, start, put)
    tail = F.substring(text, done["at"] + 1, F.length(text))
    return F.when(F.size(spans) > 0, F.concat(F.array_join(done["out"], ""), tail)).otherwise(text)


def redacted(docs: DataFrame, owner: Column, repo: Column) -> DataFrame:
    """The documents with every secret masked, live ones and copied examples by different marks.

    n_chars is counted anew where a text changed.
    """
    found = judged(docs.withColumn("text_key", text_key()), owner, repo, ["doc_id", "text_key"])
    slim = F.transform("spans", lambda m: F.struct(m["start"], m["end"], m["live"])).alias("spans")
    spans = stored(found.filter(F.size("spans") > 0).select("doc_id", "text_key", slim).dropDuplicates(["doc_id", "text_key"]), "found")
    few = spans.agg(F.sum(ROW_BYTES + SPAN_BYTES * F.size("spans"))).first()[0] or 0
    rows = join_keys(keyed(docs), spans, "left", size=few)
    text = F.when(F.col("spans").isNull(), F.col("row.text")).otherwise(masked(F.col("row.text"), F.col("spans")))

    def column(name):
        old = F.col(f"row.`{name}`")
        if name == "text":
            return F.col("text")
        return F.when(F.col("spans").isNull(), old).otherwise(F.length("text")).alias(name) if name == "n_chars" else old.alias(name)

    return rows.withColumn("text", text).select(*map(column, docs.columns))
