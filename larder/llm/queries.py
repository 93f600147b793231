"""The registered queries of the operators, over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larder.llm import byte_bpe, centroids, chat, collocations, html_text, neighbours, packing, phrases, sharding, simhash, suffixes, token_counts, toxicity
from larder.llm.common import forget, saved, table
from larder.session import checkpoint_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(plan: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = plan
        if sql is not None:
            ORACLES[name] = sql
        return plan

    return register


@query("op1_html_text")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


@query("op2_token_counts")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches: all documents come in under two vocabularies; the counts of one are revised to hold an end id;
    all copies of a text but the first go. The second batch is then sent once more, which changes nothing."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text", F.xxhash64("text").alias("same"), F.octet_length("text").alias("bytes"))
    paths = {v: public_tokenizers.path(f"{v}.tiktoken") for v in ("byte_bpe_50k", "byte_bpe_multi_50k")}
    counts = saved(token_counts.count_tokens(docs, paths, keep=("doc_id", "same", "bytes")))
    rollup = token_counts.Rollup(spark, f"{checkpoint_dir(spark).rstrip('/')}/larder-rollup-{uuid.uuid4().hex}")
    rollup.commit("load", token_counts.inserts(counts))
    ended = F.col("tokenizer_version") == "byte_bpe_50k"
    revised = counts.where(ended).withColumn("new_tokens", F.col("tokens") + 1)
    rollup.commit("end-id", token_counts.revisions(revised))
    now = counts.withColumn("tokens", F.col("tokens") + ended.cast("int"))
    first = counts.where("same is not null").groupBy("same", "bytes").agg(F.min("doc_id").alias("first"))
    copies = now.join(first, ["same", "bytes"]).where("doc_id <> first")
    rollup.commit("copies", token_counts.deletes(copies))
    rollup.commit("end-id", token_counts.revisions(revised))
    forget(counts)
    return rollup.totals()


@query("op3_decontamination")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 10).drop("_d", "_t")


@query("op4_simhash")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), 3, 3)


@query("op5_neighbours")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), 20, 20)


OP6_SQL = r"""
with extra as (
  select * from (values (-1::bigint, 0::bigint, 'user', '</s>[INST] ok [/INST]'), (-1::bigint, 1::bigint, 'assistant', '</s>[INST] ok [/INST]')) t(conv_id, turn, role, text)
), turns as (
  select conv_id, turn, coalesce(role, '') r, coalesce(text, '') b, role, text from conversations union all select conv_id, turn, role, text, role, text from extra
), sized as (
  select *, length('<s>' || replace(url_encode(r), '%20', '+') || chr(10))
    + case when r = 'user' then 15 when r = 'system' then 17 else 0 end + 6
    + length(regexp_replace(b, '(\\*(?:</?s>|\[/?INST\]|<</?SYS>>))', '\\\1', 'g')) as piece
  from turns
), placed as (
  select *, sum(piece) over w as upto, row_number() over w as nth, count(*) over (partition by conv_id) as turns_here
  from sized window w as (partition by conv_id order by turn nulls first, r, text nulls first rows unbounded preceding)
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(r || chr(10) || b || chr(10), '' order by nth)) as turns_sha256,
  coalesce(sum(length(b)) filter (r = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(b, '' order by nth) filter (r = 'assistant'), '')) as loss_sha256,
  sum(upto) filter (r = 'assistant' or nth = turns_here)::bigint as formatted_chars
from placed group by conv_id
"""


@query("op6_chat_format", OP6_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], turns.schema)
    return chat.digest(chat.examples(turns.unionByName(extra)))


@query("op7_suffix_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digest(table(spark, sf_dir, "documents"), 200)


@query("op8_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 1024)


@query("op9_sharding")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"), 24)


@query("op10_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels"))).drop("evidence")


OP3_SQL = r"""
with item_words as (
  select cast(item_id as varchar) item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from benchmark
), windows as (
  select distinct item_id, array_to_string(w[s : s + 9], ' ') win, least(len(w), 10) n
  from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) s from item_words where len(w) > 0)
), doc_words as (
  select row_number() over () rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from documents
), lengths as (select distinct n from windows), found as (
  select rid, s, n, item_id from (
    select rid, n, s, array_to_string(w[s : s + n - 1], ' ') win from (select rid, w, n, unnest(range(1, len(w) - n + 2)) s from doc_words, lengths)
  ) join windows using (win, n)
), per as (
  select rid, count(distinct p) n_hit from (select rid, unnest(range(s, s + n)) p from found) group by rid
), ids as (
  select rid, count(*) n_items, string_agg(item_id, ',' order by item_id) items from (select distinct rid, item_id from found) group by rid
)
select doc_id, len(w)::bigint n_words, coalesce(n_hit, 0)::bigint n_hit, coalesce(n_items, 0)::bigint n_items,
  sha256(coalesce(items, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from doc_words left join per using (rid) left join ids using (rid)
"""
ORACLES["op3_decontamination"] = OP3_SQL


OP11_SQL = r"""
with words as (
  select row_number() over () pid, lang, w from (
    select lang, list_filter(string_split_regex(p, '[ \t]+'), lambda x: x <> '') w from (
      select coalesce(lang, 'und') lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) p from documents
    )
  ) where len(w) > 0
), counts as materialized (
  select lang, m, phrase, count(*) f from (
    select lang, m, array_to_string(w[s : s + m - 1], ' ') phrase from (select lang, w, m, unnest(range(1, len(w) - m + 2)) s from words, (values (1), (2), (3)) t(m))
  ) group by all
), totals as (select lang, sum(len(w))::bigint n from words group by 1
), cand as materialized (select lang, m, phrase, string_split(phrase, ' ') w, f a from counts where m > 1 and f >= 10
), inner_parts as (
  select lang, array_to_string(w[s : s + 1], ' ') phrase, max(a) longer from (select lang, w, a, unnest([1, 2]) s from cand where m = 3) group by all
), kept as (select cand.* from cand left join inner_parts using (lang, phrase) where longer is null or 100 * longer < 50 * a
), cuts as (
  select c.lang, c.phrase, a, k, l.f l, r.f r, ((1000000::hugeint * a * a) // (l.f::hugeint * r.f))::bigint score from (
    select lang, phrase, a, k, array_to_string(w[1 : k], ' ') x, array_to_string(w[k + 1 : m], ' ') y from (select *, unnest(range(1, m)) k from kept)
  ) c join counts l on l.lang = c.lang and l.phrase = c.x join counts r on r.lang = c.lang and r.phrase = c.y
), best as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1
), ranked as (select *, row_number() over (partition by lang order by score desc, a desc, encode(phrase)) rank from best)
select lang, rank, phrase, a, l, r, n, score from ranked join totals using (lang) where rank <= 2000
"""


@query("op11_collocations", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), longest=3, least=10, share=50, top=2000)


@query("op12_byte_bpe")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digest(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def _op13_sql(k: int = 8, rounds: int = 10) -> str:
    """Every round as a table of its own: the nearest centroid of each vector, then the new centroids."""
    near = "select rid, c, d from (select rid, c, d, row_number() over (partition by rid order by d, c) nth from (select rid, c, sum((x - y) * (x - y)) d from comps join {0} using (i) group by all)) where nth = 1"
    parts = [
        f"""kept as materialized (
  select row_number() over () rid, vec_id, list_transform(e, lambda x: floor(1024 * x)::hugeint) v from (select vec_id, embedding::double[] e from embeddings)
  where len(e) = 64 and len(list_filter(e, lambda x: x is not null and isfinite(x))) = 64
), comps as materialized (select rid, i, v[i] x from kept, range(1, 65) t(i)
), c0 as materialized (
  select c, i, v[i] y from (select v, row_number() over (order by sha256('3:' || vec_id::varchar) nulls last, v) - 1 c from kept qualify c < {k}), range(1, 65) t(i)
)"""
    ]
    for r in range(rounds):
        parts.append(f"a{r} as materialized ({near.format(f'c{r}')})")
        parts.append(
            f"""s{r} as (select c, i, sum(x) s, count(*) n from a{r} join comps using (rid) group by all),
c{r + 1} as materialized (select c, i, case when n is null then y else (s - ((s % n) + n) % n) // n end y from c{r} left join s{r} using (c, i))"""
        )
    parts.append(f"a{rounds} as materialized ({near.format(f'c{rounds}')})")
    return "with " + ",\n".join(parts) + f"""
select vec_id, c::int cluster, d::bigint distance, (sum(d) over (partition by c))::bigint cluster_inertia, (sum(d) over ())::bigint inertia, centroid_sha256
from a{rounds} join kept using (rid) join (select c, sha256(string_agg(y::varchar, ',' order by i)) centroid_sha256 from c{rounds} group by c) using (c)"""


@query("op13_centroids", _op13_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.digest(table(spark, sf_dir, "embeddings"), k=8, rounds=10, dims=64, scale=1024, seed=3)
