"""Secret scans with corpus-wide ownership frequency, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sessionloom.llm.shared import cut

# The kinds in the order in which they are listed: pattern, group of the value, least length of the value. Failing
# matches of `assign` still take up their text, so its length is tested afterwards; a run of hex
# digits or of an access key is one match whatever its length, so there the pattern may hold the length.
KINDS = {
    "assign": ("((?i)password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 8),
    "access": ("AKIA[A-Z0-9]{12,}", 0, 16),
    "hex": ("[0-9a-f]{32,}", 0, 32),
    "bare": ("[A-Za-z0-9+/_-]{20,}", 0, 20),
}
BASE = ("assign", "access", "hex")


def _hits(text: Column, nth: int, kind: str) -> Column:
    """array<struct<kind, pos, gap, size, hash, live, keep>> of the matches of a kind: in code points, how much text lies before each (since the
    match before it), and how long it is. One scan for texts without a match."""
    pattern, group, least = KINDS[kind]
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), 0).alias("hit"))

    def hit(x: Column, i: Column) -> Column:
        value = F.regexp_extract(x["hit"], pattern, group) if group else x["hit"]
        keep = F.char_length(value) >= least
        if kind == "bare":
            keep = keep & _mixed_classes(value)
        return F.struct(
            F.lit(nth).alias("kind"), i.alias("pos"), F.char_length(x["gap"]).alias("gap"), F.char_length(x["hit"]).alias("size"), F.sha2(value, 256).alias("hash"), _looks_live(value).alias("live"), keep.alias("keep")
        )

    found = F.transform(F.filter(parts, lambda x: x["hit"].isNotNull()), hit)
    return F.when(F.regexp_like(text, F.lit(pattern)), found).otherwise(F.array().cast(HITS))


HITS = "array<struct<kind:int,pos:int,gap:int,size:int,hash:string,live:boolean,keep:boolean>>"
SPANS = "array<struct<start:bigint,kind:int,end:bigint>>"


def _mixed_classes(value: Column) -> Column:
    return value.rlike("[0-9]") & value.rlike("[A-Z]") & value.rlike("[a-z]")


def _looks_live(value: Column) -> Column:
    """Long enough, with digits and letters, and with 8 or more different characters."""
    return (F.char_length(value) >= 16) & value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (F.size(F.array_distinct(F.split(value, ""))) >= 8)


def _listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, repository: str = "doc_id", owner: str = "source", copied_owners: int = 3, copied_repositories: int = 20) -> DataFrame:
    """Spans of secrets in whole texts, and how widely each value is shared.

    Returns one row per row of docs: doc_id, n_assign, n_access, n_hex (base spans), base_sha256, spans (base ones and those
    added, as kind:start:end), n_live, n_example and most_copies (repositories of the value that most have). A null text is empty. Repeated
    rows count as one repository. A null owner is an owner of its own. Only the three columns named and the text are read.
    An empty table gives an empty result.

    Every value is hashed, and the hash's distinct repositories and owners are counted over the whole corpus. A value of
    `copied_owners` owners or of `copied_repositories` repositories, or more, is an example, however few owners copied it so often; any other
    that looks live is live. What is added: bare tokens of 20 or more characters with digits and letters of either case,
    outside of base spans, whose value is live by these counts.

    Texts are scanned once; the matches go to a table in the shared folder, and only they are shuffled. Places are running sums over a text's
    matches, so that a text of very many costs in proportion.
    """
    text = F.coalesce("text", F.lit(""))
    found = docs.select("doc_id", F.col(repository).alias("repo"), F.coalesce(F.concat(F.lit("s"), F.col(owner).cast("string")), F.lit("n")).alias("owner"), text.alias("text"))
    found = found.select("doc_id", "repo", "owner", F.concat(*[_hits(F.col("text"), n, k) for n, k in enumerate(KINDS)]).alias("hits"))
    found = cut(found.withColumn("row", F.monotonically_increasing_id()), "hits")
    each = found.where(F.size("hits") > 0).select("row", "repo", "owner", F.explode("hits").alias("h")).select("row", "repo", "owner", "h.*")
    ahead = Window.partitionBy("row", "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    each = each.withColumn("start", F.coalesce(F.sum(F.col("gap") + F.col("size")).over(ahead), F.lit(0)) + F.col("gap")).withColumn("end", F.col("start") + F.col("size")).where("keep")
    # a bare token is outside if no base span that starts before it ends in it, and none starts in it
    base = F.col("kind") < len(BASE)
    before = Window.partitionBy("row").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    behind = Window.partitionBy("row").orderBy(F.desc("start"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, -1)
    each = each.withColumns({"_end": F.max(F.when(base, F.col("end"))).over(before), "_start": F.min(F.when(base, F.col("start"))).over(behind)})
    outside = F.coalesce(F.col("_end") <= F.col("start"), F.lit(True)) & F.coalesce(F.col("_start") >= F.col("end"), F.lit(True))
    values = cut(each.where(base | outside).select("row", "repo", "owner", "kind", "start", "end", "hash", "live"), "values")
    owners = values.select("hash", "owner", "repo").distinct().groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("repos"))
    spread = owners.groupBy("hash").agg(F.count(F.lit(1)).alias("owners"), F.sum("repos").alias("repos"))
    judged = values.join(spread, "hash")
    example = (F.col("owners") >= copied_owners) | (F.col("repos") >= copied_repositories)
    live = ~example & F.col("live")
    span = F.struct("start", "kind", "end")
    verdicts = judged.groupBy("row").agg(
        *[F.count_if(F.col("kind") == n).alias(f"n_{k}") for n, k in enumerate(BASE)], F.count_if(live).alias("n_live"), F.count_if(example).alias("n_example"),
        F.collect_list(F.when(base, span)).alias("base"), F.collect_list(F.when(base | live, span)).alias("all"), F.max("repos").alias("most_copies"),
    )
    out = found.select("doc_id", "row").join(verdicts, "row", "left")
    count = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    base_list, every = (F.coalesce(c, F.array().cast(SPANS)) for c in ("base", "all"))
    return out.select("doc_id", *[count(f"n_{k}") for k in BASE], F.sha2(_listed(base_list), 256).alias("base_sha256"), _listed(every).alias("spans"), *[count(c) for c in ("n_live", "n_example", "most_copies")])
