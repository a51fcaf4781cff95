"""One query per operator over the driver's tables, and SQL for those that it can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionloom.llm import bpe, divergence, exact_dedup, line_dedup, lm_score, minhash, mixing, periodic_runs, quality_cnn, secrets, simhash, substring_dedup, warc
from sessionloom.sources.scratch import new_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(_table(spark, sf_dir, "documents"))


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target model counts the documents labelled 1, the background model all."""
    targets = _table(spark, sf_dir, "labels").where("quality = 1")
    return lm_score.score(_table(spark, sf_dir, "documents"), targets)


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality_cnn.train(docs, _table(spark, sf_dir, "labels"))
    return quality_cnn.score(docs, model, ["doc_id"]).select("doc_id", quality_cnn.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.without_boilerplate(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(_table(spark, sf_dir, "documents"), outputs=("sha",))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.without_repeats(_table(spark, sf_dir, "documents")).drop("kept_text")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.edited_fingerprints(_table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return periodic_runs.described(periodic_runs.find_runs(periodic_runs.planted(docs)))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, path = _table(spark, sf_dir, "pages"), new_path(spark, "archive")
    warc.write(pages, path)
    return warc.pages(spark, path, pages.schema["page_id"].dataType.simpleString()).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_simhash, op2_lm_score, op3_secrets, op4_quality, op5_line_dedup, op6_mixing, op7_bpe, op8_substring_dedup, op9_exact_dedup, op10_fingerprints, op11_periodic_runs, op12_warc, op13_divergence,
)}

ORACLES: dict[str, str] = {
    "op5_line_dedup": """
with split as (select doc_id, source, string_split(coalesce(text, ''), chr(10)) as lines from documents),
lines as (select doc_id, source, unnest(lines) as line, unnest(range(1, len(lines) + 1)) as pos from split),
spread as (select line from lines where trim(regexp_replace(line, '[\x09-\x0D]', ' ', 'g')) <> '' group by line having count(distinct coalesce('s' || source, 'n')) >= 3),
marked as (select l.*, s.line is not null as gone from lines l left join spread s on l.line = s.line)
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_removed,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
from marked group by doc_id""",
    "op6_mixing": """
with sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::bigint as size,
         md5(doc_id::varchar) as key
  from documents),
sources as (select source, sum(size)::bigint as source_size from sized group by source),
weighed as (select *, ((row_number() over (order by source nulls last) - 1) % 3 + 1)::bigint as weight from sources),
filled as (select *, 3 * source_size as cap, 3 * source_size / weight::double as fills from weighed),
levels as (
  select *, row_number() over o as nth,
         sum(source_size) over () - coalesce(sum(cap) over (o rows between unbounded preceding and 1 preceding), 0) as left_words,
         sum(weight) over () - coalesce(sum(weight) over (o rows between unbounded preceding and 1 preceding), 0) as left_weight
  from filled window o as (order by fills, source nulls last)),
marked as (select *, cap::double * left_weight <= left_words::double * weight as is_full from levels),
level as (select left_words::double as words, left_weight as weight from marked where not is_full order by nth limit 1),
targets as (
  select m.source, source_size, case when is_full then cap::double else l.words * m.weight / l.weight end as target
  from marked m left join level l on true),
placed as (
  select doc_id, size, source_size, target, floor(target)::bigint as budget,
         coalesce(sum(size) over (partition by s.source order by key rows between unbounded preceding and 1 preceding), 0) as before
  from sized s join targets t on s.source is not distinct from t.source)
select doc_id, size, source_size, target,
       (case when source_size = 0 then 0 else (budget // source_size) * size
        + greatest(0, least(size, budget - (budget // source_size) * source_size - before)) end)::bigint as taken
from placed""",
    "op9_exact_dedup": """
with t as (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as body from documents)
select doc_id, max(doc_id) over (partition by body) as keep_id, count(*) over (partition by body) as group_size,
       doc_id = max(doc_id) over (partition by body) as kept, sha256(body) as text_sha256
from t""",
    "op12_warc": """
with p as (select page_id, sha256(coalesce(html, '')) as payload_digest, octet_length(encode(coalesce(html, '')))::bigint as payload_bytes,
                  coalesce(html, '') as body, row_number() over (order by page_id nulls last) as row from pages),
f as (select *, first_value(row) over w as lead, first_value(page_id) over w as first from p window w as (partition by body order by page_id nulls last, row))
select page_id, payload_bytes, payload_digest, case when payload_bytes >= 100 and row <> lead then 'revisit' else 'response' end as record_type,
       case when payload_bytes >= 100 and row <> lead then first end as refers_to
from f""",
    "op13_divergence": r"""
with d as (select coalesce(lang, '') as lang, coalesce(source, '') as source,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as body,
                  row_number() over () as row from documents),
hits as (select lang, source, row, unnest(regexp_extract_all(body, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d),
kept as (select lang, term from hits group by lang, term having count(distinct row) >= 30),
counts as (select h.lang, h.source, h.term, count(*) as n from hits h join kept k using (lang, term) group by all),
grps as (select distinct lang, source from d),
sizes as (select lang, count(*) as v from kept group by lang),
sums as (select lang, source, sum(n)::hugeint as total from counts group by all),
g as (select lang, source, coalesce(total, 0)::hugeint as total, coalesce(v, 0)::hugeint as v
      from grps left join sums using (lang, source) left join sizes using (lang)),
cells as (select g.lang, g.source, k.term, coalesce(c.n, 0) as n, 1 + (1000000000::hugeint * (coalesce(c.n, 0) + 5)) // (g.total + 5 * g.v) as p
          from g join kept k on k.lang = g.lang left join counts c on c.lang = g.lang and c.source = g.source and c.term = k.term),
langs as (select lang, sum(total) as total, max(v) as v from g group by lang),
whole as (select c.lang, c.term, 1 + (1000000000::hugeint * (sum(c.n) + 5)) // (max(l.total) + 5 * max(l.v)) as q
          from counts c join langs l using (lang) group by c.lang, c.term),
far as (select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value
        from cells a join cells b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
pairs as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(f.value, 0)::bigint as value
          from grps a join grps b on a.lang = b.lang and a.source <> b.source
          left join far f on f.lang = a.lang and f.source = a.source and f.item = b.source),
terms as (select c.lang, c.source, 'term' as part, c.term as item, (c.p - w.q)::bigint as value
          from cells c join whole w using (lang, term) where c.n > 0 and c.p > w.q),
ranked as (select *, row_number() over (partition by lang, source, part order by value desc, item)::int as rank
           from (select * from pairs union all select * from terms))
select * from ranked where part = 'pair' or rank <= 50""",
}
