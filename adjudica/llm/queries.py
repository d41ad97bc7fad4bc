"""The registered queries of the subpackage; each applies one operator to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adjudica.llm import bloom_search, filter_audit, id_coder, language_ppm, license_setjoin, multiset_hash, secrets_markov, sentencepiece_table, suffix_dedup, superminhash, toxicity_mil, url_asof, winnowing
from adjudica.llm.shared import fold, table, workers_find_package
from adjudica.plans.registry import Query, Run

QUERIES: dict[str, Query] = {}


def _query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    def register(run: Run) -> Run:
        QUERIES[name] = Query(lambda spark, sf_dir: run(workers_find_package(spark), sf_dir), sql)
        return run

    return register


def tokenizer_path(name: str) -> str:
    """Where the public vocabulary file of that name lies on this machine."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


@_query("op1_sentencepiece")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = sentencepiece_table.encode_decode(table(spark, sf_dir, "documents", "doc_id", "text"), tokenizer_path("piece_bpe_32k.model"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@_query("op8_language_id")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    held_out = fold(F.col("doc_id"), 4) == 2
    model = language_ppm.fit(docs.where(~held_out))
    found = language_ppm.predict(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "bits_per_byte")


@_query("op6_toxicity")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    held_out = fold(F.col("doc_id"), 5) == 0
    model = toxicity_mil.fit(docs, table(spark, sf_dir, "labels", "doc_id", "toxic").where(~held_out))
    found = toxicity_mil.score(docs, model)
    return found.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "offending"
    )


@_query("op2_near_duplicates")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superminhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


_WORDS_SQL = r"""regexp_extract_all(translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

_OP10_SQL = f"""
with d as (select doc_id, {_WORDS_SQL.format('text')} w from documents),
b as (select item_id, {_WORDS_SQL.format('text')} w from benchmark),
bw as (select item_id, least(len(w), 10) n, array_to_string(w[s:s + least(len(w), 10) - 1], ' ') t
       from b, lateral (select unnest(range(1, greatest(len(w) - 10, 0) + 2)) s) where len(w) > 0),
lens as (select distinct n from bw),
dw as (select doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') t
       from d, lens, lateral (select unnest(range(1, len(w) - n + 2)) s)),
hits as (select dw.doc_id, dw.s, dw.n, bw.item_id from dw join bw on dw.t = bw.t and dw.n = bw.n),
hw as (select doc_id, count(distinct p) n_hit from (select doc_id, unnest(range(s, s + n)) p from hits) group by 1),
hi as (select doc_id, count(*) n_items, string_agg(i, ',' order by i) l
       from (select distinct doc_id, cast(item_id as varchar) i from hits) group by 1)
select d.doc_id, cast(len(w) as bigint) n_words, cast(coalesce(n_hit, 0) as bigint) n_hit,
  cast(coalesce(n_items, 0) as bigint) n_items, sha256(coalesce(l, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from d left join hw using (doc_id) left join hi using (doc_id)
"""


@_query("op10_decontamination", _OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text")
    found = winnowing.contamination(docs, items)
    return found.select(
        "doc_id",
        "n_words",
        winnowing.covered(F.col("hits")).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


@_query("op5_fingerprints")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = multiset_hash.with_edits(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        multiset_hash.as_text(F.col("vector")).alias("fingerprint"),
        multiset_hash.as_text(F.col("edited_vector")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


@_query("op7_license_scan")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_setjoin.license_scan(table(spark, sf_dir, "documents", "doc_id", "text"))
    starts, base = F.col("found.start"), F.array_sort(F.array_distinct("found.label"))
    more = F.array_sort(F.array_distinct(F.concat("found.label", "blocks.label")))
    best = F.coalesce(F.array_max("blocks.share"), F.lit(0.0))
    return found.select(
        "doc_id",
        "n_words",
        F.size("found").cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(more, ",").alias("labels"),
        F.when(F.size("found") > 0, 1.0).otherwise(best).alias("score"),
        "blocks",
    )


@_query("op3_secrets")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = secrets_markov.scan(docs, secrets_markov.fit(docs))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    base = secrets_markov.listed(secrets_markov.by_start(F.col("base")))
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(base.cast("binary"), 256).alias("base_sha256"),
        secrets_markov.listed(secrets_markov.by_start(F.concat("base", "added"))).alias("spans"),
    )


@_query("op9_coded_ids")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    path = id_coder.files_folder(spark)
    id_coder.write_ids(docs, tokenizer_path("word_bpe_49k.json"), 2, path)
    return id_coder.read_ids(spark, path).select("doc_id", "start", "n_tokens", F.crc32("tokens").alias("ids_crc32"))


# The tables hold no lists and no fetch dates. Every page is also taken as a report that lists its host, its
# parent domain or the first part of its path, with an action and a day that follow from its number.
_OP4_SQL = r"""
with p as (select page_id, url, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)) host,
    list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([^?#]*)', 1), '/'), lambda x: x <> '') parts,
    date '2024-01-01' + cast(page_id * 53 % 366 as integer) fetched_on,
    date '2024-01-01' + cast(page_id * 37 % 366 as integer) listed_on,
    case page_id // 3 % 3 when 0 then 'block' when 1 then 'allow' else 'remove' end act from pages),
e as (select page_id, act, listed_on, case page_id % 3 when 0 then host when 1 then regexp_replace(host, '^[^.]+\.', '')
    else host || coalesce('/' || parts[1], '') end pattern from p),
day as (select pattern, listed_on, arg_max(act, page_id) act from e group by all),
iv as (select pattern, act, listed_on since, lead(listed_on) over (partition by pattern order by listed_on) until from day),
k as (select page_id, fetched_on, unnest(list_distinct(list_concat(
    [array_to_string(string_split(host, '.')[i:], '.') for i in range(1, greatest(len(string_split(host, '.')) - 1, 1) + 1)],
    [host || '/' || array_to_string(parts[1:i], '/') for i in range(1, len(parts) + 1)]))) pattern from p where host <> ''),
m as (select page_id, arg_max(struct_pack(pattern := k.pattern, act := act, since := since), length(k.pattern)) b
    from k join iv on k.pattern = iv.pattern and since <= fetched_on and (until is null or fetched_on < until) and act <> 'remove' group by 1)
select p.page_id, p.fetched_on, coalesce(b.act, 'none') verdict, b.pattern pattern, b.since since from p left join m using (page_id)
"""


@_query("op4_url_filter", _OP4_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", "page_id", "url")
    day = lambda step: F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") * step % 366).cast("int"))
    host, part = url_asof.host_of(F.col("url")), F.get(F.array_remove(F.split(url_asof.path_of(F.col("url")), "/"), ""), 0)
    turn, deed = F.col("page_id") % 3, F.floor(F.col("page_id") / 3) % 3
    entries = pages.select(
        F.col("page_id").alias("entry_id"),
        day(37).alias("listed_on"),
        F.when(deed == 0, url_asof.BLOCK).when(deed == 1, url_asof.ALLOW).otherwise(url_asof.REMOVE).alias("action"),
        F.when(turn == 0, host).when(turn == 1, F.regexp_replace(host, r"^[^.]+\.", "")).otherwise(F.concat(host, F.coalesce(F.concat(F.lit("/"), part), F.lit("")))).alias("pattern"),
    )
    return url_asof.filter_urls(pages.withColumn("fetched_on", day(53)), entries)


_OP12_SQL = r"""
with recursive letters as (select unnest(['A', 'B', 'C', 'D', 'E']) x),
orders as (select x filter_order from letters union all
    select filter_order || x from orders, letters where length(filter_order) < 5 and not contains(filter_order, x)),
o as (select filter_order, unnest(range(1, 6)) step from orders where length(filter_order) = 5),
t as (select doc_id, coalesce(source, '') part, coalesce(text, '') text from documents),
w as (select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') w from t),
first as (select text, min(doc_id) first from t group by 1),
marks as (select doc_id, max(coalesce(quality = 1, false)) good, max(coalesce(toxic = 1, false)) toxic from labels group by 1),
f as (select w.doc_id, part, case when len(w) < 200 then 'A' else '' end || case when 100 * len(list_distinct(w)) < 50 * len(w) then 'B' else '' end
    || case when 100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) then 'C' else '' end
    || case when regexp_matches(text, '[#$%&*|]') then 'D' else '' end
    || case when w.doc_id > first then 'E' else '' end fails, coalesce(good, false) good, coalesce(toxic, false) toxic
    from w join first using (text) left join marks using (doc_id)),
c as (select part, fails, count(*) n, count(*) filter (good) good, count(*) filter (toxic) toxic from f group by all),
s as (select part, filter_order, step, n, good, toxic, fails, contains(fails, substr(filter_order, step, 1)) here,
    translate(substr(filter_order, 1, step - 1), fails, '') <> substr(filter_order, 1, step - 1) gone from c, o),
r as (select part, filter_order, step, cast(sum(case when not here and not gone then n else 0 end) as bigint) kept,
    cast(sum(case when here and not gone then n else 0 end) as bigint) removed, cast(sum(case when here and gone then n else 0 end) as bigint) redundant,
    cast(sum(case when here and length(fails) = 1 then n else 0 end) as bigint) unique_fails,
    cast(sum(case when here and not gone then good else 0 end) as bigint) good_lost,
    cast(sum(case when here and not gone then toxic else 0 end) as bigint) toxic_lost from s group by all)
select part, filter_order, cast(step as integer) step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  cast(sum(removed) over (partition by part, substr(filter_order, step, 1)) as bigint) shapley from r
"""


@_query("op12_filter_audit", _OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source")
    return filter_audit.audit(filter_audit.masks(docs, table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")))


_TERMS_SQL = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

_OP13_SQL = f"""
with d as (select doc_id, {_TERMS_SQL} w from documents), sizes as (select count(*) n, sum(len(w)) l from d where len(w) > 0),
q as (select item_id, t, count(*) times from (select item_id, unnest({_TERMS_SQL}) t from benchmark) group by all),
tf as (select doc_id, n, t, count(*) tf from (select doc_id, len(w) n, unnest(w) t from d) group by all),
df as (select t, count(*) df from tf group by 1),
s as (select item_id, doc_id, sum(times * cast(floor(1000 * ln((2 * sizes.n + 2) / (2 * df + 1))) as bigint)
    * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * tf.n * sizes.n) // cast(l as bigint))))) score
    from q join tf using (t) join df using (t), sizes group by all),
r as (select *, row_number() over (partition by item_id order by score desc, doc_id) rank from s where score > 0)
select item_id, cast(rank as integer) rank, doc_id, cast(score as bigint) score from r where rank <= 20
"""


@_query("op13_ranked_search", _OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bloom_search.search(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))


@_query("op11_suffix_dedup")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text"))
    return left.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")
