r"""Secrets, told apart by how many owners hold them. DataFrame functions only.

Candidates are found by patterns, their values hashed, and the hashes counted over the whole corpus by distinct repositories and
owners. A value that several owners hold (`SHARED_BY`), or that stands in very many repositories, if only of one owner
(`COPIED_INTO`), has been copied around and is an example; one that few hold is taken for live. Only hashes are ever stored.

Base kinds, leftmost and non-overlapping each, failing matches dropped, which stay whatever the counts say:
assign `(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)`, the words in either case, value of 8
or more characters; access `AKIA[A-Z0-9]+` of 16 or more; hex `[0-9a-f]+` of 32 or more.
Added by the method: opaque, runs of 24 or more of `[A-Za-z0-9+/_-]` that mix digits with small and capital letters, overlap no
base span and are held by one owner alone.

Every text is searched whole. NULL and empty texts have no spans. A NULL owner or repository counts as one owner or repository.
Repeated rows are one repository and owner, and each gets its result. Spans are code points, end exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.session import settle

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# Kind, pattern, group of the value, least length of the value. A run shorter than the limit holds no longer one, so the limit
# can stand in the pattern of access and hex; that of assign is looked at afterwards.
KINDS = [("assign", ASSIGN, 2, 8), ("access", "AKIA[A-Z0-9]{12,}", 0, 16), ("hex", "[0-9a-f]{32,}", 0, 32), ("opaque", "[A-Za-z0-9+/_-]{24,}", 0, 24)]
BASE = [k[0] for k in KINDS[:3]]
# Any text with a candidate matches this.
SUSPECT = r"(?i:passw|secret|token|api_?key)|AKIA[A-Z0-9]|[0-9a-f]{32}|[A-Za-z0-9+/_-]{24}"
SHARED_BY, COPIED_INTO = 3, 100


def _regex(pattern: str) -> Column:
    return F.lit(pattern)


def _hits(text: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    """The kind's matches in order: length of the text before each since the last match, length of the match, hash of its value if it
    is one."""
    whole = F.regexp_extract_all(text, _regex(pattern), F.lit(0))
    value = F.regexp_extract_all(text, _regex(pattern), F.lit(group)) if group else whole
    before = F.transform(F.split(text, pattern, -1), lambda x: F.char_length(x))
    zipped = F.arrays_zip(before.alias("before"), whole.alias("whole"), value.alias("value"))
    # One piece more than matches: the rest behind the last.
    def hit(m: Column) -> Column:
        fits = F.char_length(m["value"]) >= least
        if kind == "opaque":
            fits = fits & _looks_opaque(m["value"])
        # The value itself goes no further: what is stored is its hash.
        return F.struct(F.lit(kind).alias("kind"), m["before"].alias("before"), F.char_length(m["whole"]).alias("size"), F.when(fits, F.sha2(m["value"], 256)).alias("value_hash"))

    return F.transform(F.slice(zipped, F.lit(1), F.size(whole)), hit)


def _looks_opaque(value: Column) -> Column:
    return value.rlike("[0-9]") & value.rlike("[a-z]") & value.rlike("[A-Z]")


def candidates(docs: DataFrame, text: str = "text", id: str = "doc_id", owner: str = "source", repo: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """All rows (`uid`, id, `text_key`), and one row for each candidate: `uid`, `kind`, `start`, `end`, `value_hash`, `owner`, `repo`.

    The texts are read once; what was found is written to the shared folder, with a number for each row.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    kind_type = "array<struct<kind:string,before:int,size:int,value_hash:string>>"
    found = F.flatten(F.array(*[_hits(body, *kind) for kind in KINDS]))
    narrow = docs.select(
        F.monotonically_increasing_id().alias("uid"),
        F.col(id).cast("long").alias("id"),
        F.xxhash64(body).alias("text_key"),
        F.col(owner).cast("string").alias("owner"),
        F.col(repo).cast("string").alias("repo"),
        F.when(body.rlike(SUSPECT), found).otherwise(F.array().cast(kind_type)).alias("found"),
    )
    kept = settle(narrow, "secrets")
    hits = kept.where(F.size("found") > 0).select("uid", "owner", "repo", F.posexplode("found").alias("place", "hit")).select("uid", "owner", "repo", "place", "hit.*")
    # Places count on within a document and kind, so its window is bounded by the text.
    so_far = Window.partitionBy("uid", "kind").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    placed = hits.withColumn("end", F.sum(F.col("before") + F.col("size")).over(so_far)).withColumn("start", F.col("end") - F.col("size"))
    spans = placed.where("value_hash IS NOT NULL").select("uid", "kind", "start", "end", "value_hash", "owner", "repo")
    return kept.select("uid", "id", "text_key"), spans


def ownership(spans: DataFrame) -> DataFrame:
    """`value_hash`, `owners` and `repos`: in how many distinct ones each value stands.

    Counted in steps, each reduced per task first, so that a value that stands everywhere is spread over its repositories.
    """
    by_repo = spans.groupBy("value_hash", "owner", "repo").agg(F.lit(1).alias("one"))
    by_owner = by_repo.groupBy("value_hash", "owner").agg(F.count("*").alias("repos"))
    # A repository has one owner; one that is listed under several counts for each.
    return by_owner.groupBy("value_hash").agg(F.count("*").alias("owners"), F.sum("repos").alias("repos"))


def judged(spans: DataFrame, shared_by: int = SHARED_BY, copied_into: int = COPIED_INTO) -> DataFrame:
    """Candidates with `owners`, `repos` and `live`; opaque ones only where they count."""
    live = (F.col("owners") < shared_by) & (F.col("repos") < copied_into)
    known = spans.join(ownership(spans), "value_hash").withColumn("live", live)
    opaque = known.where("kind = 'opaque' AND owners = 1")
    base = known.where("kind <> 'opaque'")
    # Both sides of this join are the spans of one document.
    apart = opaque.alias("o").join(base.alias("b"), F.expr("o.uid = b.uid AND o.start < b.end AND b.start < o.end"), "left_anti")
    return base.unionByName(apart)


def _listed(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed, joined by commas."""
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def scan(docs: DataFrame, text: str = "text", id: str = "doc_id", owner: str = "source", repo: str = "doc_id", shared_by: int = SHARED_BY, copied_into: int = COPIED_INTO) -> DataFrame:
    """One row for each document: id, `text_key`, counts of the base kinds, `base_sha256`, all `spans`, `n_live`, `n_example`, the
    `most_owners` and `most_repos` that one of its values has, and the `live_spans` as an array of start and end."""
    rows, spans = candidates(docs, text, id, owner, repo)
    rank = F.create_map(*[F.lit(x) for n, (k, *_) in enumerate(KINDS) for x in (k, n)])[F.col("kind")]
    span = F.struct("start", rank.alias("rank"), "kind", "end")
    is_base = F.col("kind") != "opaque"
    per_row = (
        judged(spans, shared_by, copied_into)
        .groupBy("uid")
        .agg(
            *[F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}") for k in BASE],
            F.collect_list(F.when(is_base, span)).alias("base"),
            F.collect_list(span).alias("every"),
            F.count(F.when(F.col("live"), 1)).alias("n_live"),
            F.count(F.when(~F.col("live"), 1)).alias("n_example"),
            F.max("owners").alias("most_owners"),
            F.max("repos").alias("most_repos"),
            F.array_sort(F.collect_list(F.when(F.col("live"), F.struct("start", "end")))).alias("live_spans"),
        )
    )
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    joined = rows.join(per_row, "uid", "left")
    return joined.select(
        F.col("id").alias(id),
        "text_key",
        *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(F.coalesce(_listed(F.col("base")), F.lit("")).cast("binary"), 256).alias("base_sha256"),
        F.coalesce(_listed(F.col("every")), F.lit("")).alias("spans"),
        F.coalesce("n_live", F.lit(0)).cast("long").alias("n_live"),
        F.coalesce("n_example", F.lit(0)).cast("long").alias("n_example"),
        F.coalesce("most_owners", F.lit(0)).cast("long").alias("most_owners"),
        F.coalesce("most_repos", F.lit(0)).cast("long").alias("most_repos"),
        F.coalesce(F.col("live_spans").cast("array<struct<start:bigint,end:bigint>>"), none).alias("live_spans"),
    )


def redact(docs: DataFrame, text: str = "text", id: str = "doc_id", owner: str = "source", repo: str = "doc_id", mask: str = "[secret]", shared_by: int = SHARED_BY) -> DataFrame:
    """`docs` with live secrets replaced by `mask`; columns and rows stay, texts without one are untouched."""
    found = scan(docs, text, id, owner, repo, shared_by).where("n_live > 0").select(F.col(id).alias("id"), "text_key", F.col("live_spans").alias("spans"))
    # Equal texts of equal id have equal spans.
    found = found.groupBy("id", "text_key").agg(F.first("spans").alias("spans"))
    suspect = F.coalesce(F.col(text).rlike(SUSPECT), F.lit(False))
    # The row travels as one column, so that its names can't clash with those used here.
    hit = docs.where(suspect).select(F.struct(*docs.columns).alias("row"), F.col(id).cast("long").alias("own"), F.col(text).alias("body"), F.xxhash64(text).alias("own_key"))
    hit = hit.join(found, F.expr("own <=> id AND own_key = text_key"), "left").select("row", "body", "spans")
    # Spans of one document may touch or overlap across kinds: a piece begins where the furthest span so far has ended.
    hit = hit.withColumn("reach", F.transform("spans", lambda s, k: F.array_max(F.transform(F.slice("spans", F.lit(1), k + 1), lambda x: x["end"]))))
    begin = lambda k: F.when(k == 0, F.lit(0).cast("long")).otherwise(F.element_at("reach", F.greatest(k, F.lit(1))))
    hit = hit.withColumn("bounds", F.transform("spans", lambda s, k: F.struct(begin(k).alias("from"), s["start"].alias("to"), k.alias("k"))))
    kept = F.filter("bounds", lambda b: (b["k"] == 0) | (b["to"] >= b["from"]))
    pieces = F.transform(kept, lambda b: F.substring(F.col("body"), (b["from"] + 1).cast("int"), F.greatest(b["to"] - b["from"], F.lit(0)).cast("int")))
    rest = F.substring(F.col("body"), (F.element_at("reach", -1) + 1).cast("int"), F.lit(2**31 - 1))
    masked = F.when(F.col("spans").isNotNull(), F.array_join(F.concat(pieces, F.array(rest)), mask)).otherwise(F.col("body"))
    done = hit.select(*[masked.alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns])
    return docs.where(~suspect).unionByName(done)
