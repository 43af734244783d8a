"""Registered queries of the training-data operators: ``QUERIES`` by name, ``SQL`` where plain SQL gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, credential_scan, exact_dedup, line_quality, mixing, near_dedup, packing, quality_cnn, sharding, spelling,
               substring_dedup, url_filter, whitening)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql.strip()
        return fn
    return wrap


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


@query("op1_substring_dedup", rf"""
with t as (select doc_id, {WORDS} as w from documents),
win as (select doc_id, i, md5(array_to_string(w[i:i+49], ' ')) as k from (select doc_id, w, unnest(range(1, len(w) - 48)) as i from t where len(w) >= 50)),
least_doc as (select k, min(doc_id) as m from win group by k),
gone as (select distinct doc_id, i + j as p from win join least_doc using (k), range(50) g(j) where m < doc_id),
words as (select doc_id, p, w[p] as x from (select doc_id, w, unnest(range(1, len(w) + 1)) as p from t)),
kept as (select doc_id, string_agg(x, ' ' order by p) as s, count(*) as n from words anti join gone using (doc_id, p) group by doc_id)
select t.doc_id, len(w) as n_words, len(w) - coalesce(n, 0) as n_removed, sha256(coalesce(s, '')) as kept_sha256
from t left join kept using (doc_id)""")
def op1(spark, folder):
    """Words of documents without passages of 50 words and more that start in an earlier document."""
    out = substring_dedup.remove_repeats(table(spark, folder, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


@query("op2_sharding")
def op2(spark, folder):
    """All documents in eight shards of equal row counts, equal texts together."""
    out = sharding.balanced_shards(table(spark, folder, "documents"), 8)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("op3_url_filter")
def op3(spark, folder):
    """Verdict on every page's url."""
    model = url_filter.fit(url_filter.labelled_urls(spark))
    return url_filter.judge(table(spark, folder, "pages"), model, limit=url_filter.LIMIT).select("page_id", "host", "path", "rule", "verdict", "score")


@query("op4_packing")
def op4(spark, folder):
    """All documents as token pieces in sequences of 2,048."""
    out = packing.pack(table(spark, folder, "documents"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "sequence_tokens")


@query("op5_exact_dedup", """
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size, doc_id = max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
from documents window same as (partition by coalesce(text, ''))""")
def op5(spark, folder):
    """Copies of equal texts; the largest doc_id stays."""
    return exact_dedup.exact_duplicates(table(spark, folder, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op6_line_quality", rf"""
with t as (select doc_id, coalesce(text, '') as x, coalesce(source, '') as host, {WORDS} as w from documents),
win as (select doc_id, i, md5(array_to_string(w[i:i+7], ' ')) as k from (select doc_id, w, unnest(range(1, len(w) - 6)) as i from t where len(w) >= 8)),
again as (select doc_id, k from win group by all having count(*) > 1),
covered as (select doc_id, count(distinct i + j) as n from win join again using (doc_id, k), range(8) g(j) group by doc_id),
lines as (select doc_id, host, x, line from (select doc_id, host, x, unnest(string_split(x, chr(10))) as line from t) where regexp_matches(line, '[^\x20\x09-\x0D]')),
dup as (select doc_id, count(*) - count(distinct line) as n from lines group by doc_id),
norm as (select doc_id, host, x, regexp_extract_all(regexp_replace(translate(line, '{url_filter.UPPER}', '{url_filter.LOWER}'), '[0-9]', '0', 'g'), '[^\x20\x09-\x0D]+') as lw from lines),
hosts as (select host, count(distinct x) as docs from t group by host),
common as (select host, lw from norm join hosts using (host) group by host, lw, docs
           having count(distinct x) > {line_quality.MIN_DOCS} and count(distinct x) > docs * {line_quality.MIN_SHARE}::double),
gone as (select doc_id, sum(len(lw))::bigint as g from norm join common using (host, lw) group by doc_id),
base as (select doc_id, len(w) as n_words, coalesce(list_sum(list_transform(w, lambda y: length(y))), 0)::bigint as word_chars, len(regexp_extract_all(x, '[#*$%&|<>]')) as n_symbols,
         coalesce(dup.n, 0) as n_dup_lines, coalesce(covered.n, 0) as n_repeat_words, coalesce(g, 0) as n_line_words
         from t left join covered using (doc_id) left join dup using (doc_id) left join gone using (doc_id)),
judged as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from base)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and not (n_line_words > 0 and (n_words - n_line_words < {line_quality.LEFT_WORDS} or n_words - n_line_words < {line_quality.LEFT_SHARE}::double * n_words)) as kept, n_line_words
from judged""")
def op6(spark, folder):
    """Base measures of every document, and the verdict after boilerplate lines of its source are out."""
    return line_quality.judge(table(spark, folder, "documents"))


@query("op7_credential_scan")
def op7(spark, folder):
    """Secrets in every document: fixed patterns and learned formats."""
    spans = F.col("spans")
    told = lambda kinds: F.array_join(F.transform(F.filter(spans, lambda s: s.kind.isin(kinds)), lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
    count = lambda kind: F.size(F.filter(spans, lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")
    base = list(credential_scan.LEAST)
    return credential_scan.scan(table(spark, folder, "documents")).select(
        "doc_id", *[count(k) for k in base], F.sha2(told(base).cast("binary"), 256).alias("base_sha256"), told(list(credential_scan.KINDS)).alias("spans"))


@query("op8_quality_classifier")
def op8(spark, folder):
    """Quality score of every document."""
    docs = table(spark, folder, "documents")
    return quality_cnn.score(docs, quality_cnn.train(docs, table(spark, folder, "labels"))).select("doc_id", "held_out", "score", "predicted")


@query("op9_near_dedup", rf"""
with recursive t as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{url_filter.UPPER}', '{url_filter.LOWER}'), '[^\x20\x09-\x0D]+') as w from documents),
s as (select distinct doc_id, md5(array_to_string(w[i:i+4], ' ')) as k from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) as i from t where len(w) > 0)),
n as (select doc_id, count(*) as n from s group by doc_id),
pairs as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.k = b.k and a.doc_id <> b.doc_id group by all),
link as (select a, b from pairs join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 75 * (x.n + y.n - c)),
reach(a, b) as (select a, b from link union select reach.a, link.b from reach join link on reach.b = link.a),
low as (select a as doc_id, min(b) as m from reach group by a)
select t.doc_id, coalesce(n.n, 0) as n_shingles, least(t.doc_id, coalesce(m, t.doc_id)) as component_id, t.doc_id = least(t.doc_id, coalesce(m, t.doc_id)) as kept
from t left join n using (doc_id) left join low using (doc_id)""")
def op9(spark, folder):
    """Components of near-duplicates; the smallest doc_id of each stays."""
    return near_dedup.near_duplicates(table(spark, folder, "documents"))


# Production parameters of the mix: domains are ranges of sources, and English outweighs the other languages
MIX_WEIGHTS = {"domain": {"web": 5, "books": 3, "code": 2}, "lang": {"en": 6, "de": 2, "*": 1}}
MIX_SHARE, MIX_EPOCHS, MIX_SEED = 0.7, 2, 11


def mix_levels() -> dict:
    number = F.regexp_extract("source", "([0-9]+)$", 1).cast("int")
    return {"domain": F.when(number < 10, "web").when(number < 16, "books").otherwise("code"), "lang": F.col("lang"), "source": F.col("source")}


def _mix_sql() -> str:
    """The same budgeting, one level after the other, in plain SQL."""
    levels = ["domain", "lang", "source"]
    case = "case regexp_extract(source, '([0-9]+)$', 1) when '' then 'code' else case when cast(regexp_extract(source, '([0-9]+)$', 1) as int) < 10 then 'web' when cast(regexp_extract(source, '([0-9]+)$', 1) as int) < 16 then 'books' else 'code' end end"
    parts = [f"""rows as (select doc_id, len({WORDS}) as n_tokens, {case} as domain, coalesce(lang, '') as lang, coalesce(source, '') as source from documents),
leaf as (select domain, lang, source, sum(n_tokens)::bigint as have, sum(n_tokens)::double * {MIX_EPOCHS} as cap from rows group by all),
given0 as (select least(floor(sum(have) * {MIX_SHARE}::double), sum(cap)) as given from leaf)"""]
    for k, name in enumerate(levels, 1):
        path, above = ", ".join(levels[:k]), ", ".join(levels[:k - 1])
        weights = MIX_WEIGHTS.get(name, {})
        w = "case " + name + "".join(f" when '{v}' then {x}" for v, x in weights.items() if v != "*") + f" else {weights.get('*', 1)} end" if weights else "1"
        by = f"partition by {above} " if above else ""
        join = f"join given{k - 1} using ({above})" if above else f", given{k - 1}"
        parts.append(f"""node{k} as (select *, {w}::double as w from (select {path}, sum(cap) as cap from leaf group by {path}) {join}),
level{k} as (select *, (given - coalesce(sum(cap) over ({by}order by cap / w, {name} rows between unbounded preceding and 1 preceding), 0))
  / sum(w) over ({by}order by cap / w, {name} rows between current row and unbounded following) as lv from node{k} where w > 0 and cap > 0),
given{k} as (select {path}, least(cap, w * max(lv) over ({by})) as given from level{k})""")
    parts.append(f"""budget as (select {", ".join(levels)}, have, floor(given + 1e-6)::bigint as budget from leaf join given3 using ({", ".join(levels)})),
chosen as (select rows.*, have, (budget // have)::int as full_epochs, budget - (budget // have) * have as rest from rows join budget using ({", ".join(levels)}) where n_tokens > 0 and budget > 0),
last_epoch as (select *, sum(n_tokens) over (partition by {", ".join(levels)} order by md5(concat_ws(':', '{MIX_SEED}', full_epochs, doc_id)), doc_id)::bigint - n_tokens as start from chosen where rest > 0)""")
    columns = f"doc_id, {', '.join(levels)}"
    return "with " + ",\n".join(parts) + f"""
select {columns}, epoch::int as epoch, n_tokens, n_tokens as taken from (select *, unnest(range(full_epochs)) as epoch from chosen where full_epochs > 0)
union all
select {columns}, full_epochs, n_tokens, least(n_tokens, rest - start) from last_epoch where start < rest"""


@query("op10_mixing", _mix_sql())
def op10(spark, folder):
    """Documents chosen for a mix of 70 % of the corpus by domain, language and source."""
    return mixing.mix(table(spark, folder, "documents"), mix_levels(), MIX_WEIGHTS, MIX_SHARE, MIX_EPOCHS, MIX_SEED)


@query("op11_spelling_variants")
def op11(spark, folder):
    """Words of the corpus with their near words, the form each is a variant of, and the last form on the way."""
    words = spelling.corpus_words(table(spark, folder, "documents"))
    return spelling.spelling_variants(words).select("word", "form", "root", "n", "n_near", "form_n")


@query("op12_embedding_whitening")
def op12(spark, folder):
    """Whitened components of every embedding."""
    return whitening.whiten(table(spark, folder, "embeddings"))


@query("op13_bpe_round_trip")
def op13(spark, folder):
    """Digests of every document's ids and of the bytes these decode to."""
    ids = bpe.encode(table(spark, folder, "documents"))
    told = F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256)
    back = bpe.decode(ids.select("doc_id", "n_tokens", told.alias("ids_sha256"), "ids"))
    return back.select("doc_id", "n_tokens", "ids_sha256", F.sha2("body", 256).alias("decoded_sha256"))
