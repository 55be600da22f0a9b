"""Registered queries of the subpackage, with production parameters, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.llm import binary, classifier, conversations, graph_search, language, licenses, merkle, mixing, ngram_join, outliers, packing, secret_scan, url_filters
from tidecast.llm.staging import new_path
from tidecast.plans.catalog import WITH_PYTHON

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    def register(fn: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op3_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 ids of the word vocabulary."""
    pieces = packing.cut_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(pieces)


MIXING_SQL = r"""
with sizes as (select doc_id, source, cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as bigint) as size
  from documents),
per as (select source, cast(sum(size) as bigint) as source_size,
    [5.0::double, 2.0::double, 1.0::double][(row_number() over (order by source nulls last) - 1) % 3 + 1] as w
  from sizes group by source),
lim as (select *, cast(source_size * 2 as double) as lim, cast(sum(source_size) over () as bigint) as total from per),
lev as (select *, (total * 1.5::double - coalesce(sum(lim) over (order by lim / w, source nulls last
      rows between unbounded preceding and 1 preceding), 0::double))
    / (sum(w) over () - coalesce(sum(w) over (order by lim / w, source nulls last
      rows between unbounded preceding and 1 preceding), 0::double)) as lev from lim),
stop as (select *, max(lev) over () as stop from lev),
targets as (select source, source_size, total, least(lim, stop * w) as target from stop),
every as (select s.doc_id, s.source, s.size, t.source_size, t.target, t.total
  from sizes s join targets t on s.source is not distinct from t.source),
queued as (select *, md5(cast(doc_id as varchar) || ':7') as k from every where size > 0),
ends as (select *, sum(size) over (partition by source order by k, doc_id, size
    rows between unbounded preceding and current row) as e from queued),
copies as (select *, (e + r * source_size) / target as finish from ends, (values (0), (1)) as reps(r)),
mixed as (select *, sum(size) over (order by finish, source, e, doc_id
    rows between unbounded preceding and current row) as upto from copies),
got as (select doc_id, source, count(*) as n from mixed where upto <= floor(total * 1.5::double) group by all)
select e.doc_id, e.size, e.source_size, e.target, cast(coalesce(g.n * e.size, 0) as bigint) as taken
from every e left join got g on e.doc_id = g.doc_id and e.source is not distinct from g.source
"""


@query("op4_weighted_fair_queueing", MIXING_SQL)
def weighted_fair_queueing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix of 150 % of all words, weights 5, 2, 1 and at most 2 repeats takes of each document."""
    return mixing.taken(*mixing.queue(table(spark, sf_dir, "documents"))).drop("source")


@query("op8_simple8b_ids")
def simple8b_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index of the corpus, decoded from the files written for it."""
    path = new_path(spark, "ids")
    binary.write_ids(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return binary.corpus_index(spark, path)


@query("op6_ngram_jaccard_join")
def ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of four-word n-grams have a Jaccard similarity of 0.85 or more."""
    return ngram_join.join_components(table(spark, sf_dir, "documents"))


@query("op10_randomness_battery")
def randomness_battery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all documents by pattern and by randomness."""
    docs = table(spark, sf_dir, "documents")
    return secret_scan.scan(docs, secret_scan.fit(docs))


@query("op1_crf_language")
def crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of all documents, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    return language.predict(docs, language.fit(docs))


@query("op2_covariance_outliers")
def covariance_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of all documents and which of them are kept."""
    return outliers.judge(table(spark, sf_dir, "documents")).drop("distance", *outliers.STATISTICS)


@query("op5_pruned_graph_search")
def pruned_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of every twentieth vector."""
    rows = table(spark, sf_dir, "embeddings")
    index = graph_search.build_index(rows)
    return graph_search.search(index, rows.where("vec_id % 20 = 0"))


def _license_sql() -> str:
    """The canonical form and the lookup in SQL."""

    def canonical(text: str) -> str:
        t = f"regexp_replace(lower({text}), '©|\\(c\\)', ' copyright ', 'g')"
        t = f"regexp_replace({t}, '[^a-z0-9\n]+', ' ', 'g')"
        t = f"regexp_replace({t}, '(?m)^ ?copyright [^\n]*$|^ ?all rights reserved ?$', '', 'g')"
        for old, new in licenses.SPELLINGS:
            t = f"regexp_replace({t}, '\\b{old}\\b', '{new}', 'g')"
        return f"list_transform(string_split({t}, chr(10)), lambda x: trim(x))"

    known = ", ".join("('" + name + "', '" + text.replace("'", "''") + "')" for name, text in licenses.KNOWN)
    return f"""
with known as (select l, array_to_string(list_filter({canonical("t")}, lambda x: x != ''), ' ') as t from (values {known}) as k(l, t)),
listed as (select sha256(t) as digest, min(l) as license from known where t != '' group by 1),
docs as (select doc_id, {canonical("text")} as lines from documents),
parts as (select doc_id, lines, array_to_string(list_filter(lines, lambda x: x != ''), ' ') as whole,
    list_transform(string_split_regex(array_to_string(lines, chr(10)), '\n\n+'), lambda p: trim(replace(p, chr(10), ' '))) as paragraphs from docs),
units as (select doc_id, unnest(list_concat(lines, list_filter(paragraphs, lambda p: not list_contains(lines, p)))) as t, false as all_ from parts
  union all select doc_id, whole, true from parts),
hits as (select doc_id, all_, license from units join listed on sha256(t) = digest),
got as (select doc_id, min(case when all_ then license end) as whole_license,
    coalesce(string_agg(distinct case when not all_ then license end, ',' order by case when not all_ then license end), '') as notices,
    count(case when not all_ then 1 end) as n_notices from hits group by 1)
select d.doc_id, g.whole_license, coalesce(g.notices, '') as notices, cast(coalesce(g.n_notices, 0) as bigint) as n_notices
from documents d left join got g using (doc_id)
"""


@query("op7_license_digests", _license_sql())
def license_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences and notices in all documents."""
    return licenses.find_licenses(table(spark, sf_dir, "documents"), licenses.known_licenses(spark))


URL_SQL = r"""
with caps as (select page_id, url, timestamp '2024-01-01' + to_seconds(cast((page_id * 7919) % 2592000 as bigint)) as fetched,
    lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:@]+)', 1)) as host,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([^/?#]+)', 1) as seg from pages),
labels as (select *, string_split(host, '.') as l from caps),
pats as (select distinct page_id, fetched, pattern from (
  select page_id, fetched, array_to_string(l[i:], '.') as pattern, host
    from (select *, unnest(range(1, cast(greatest(len(l) - 1, 1) + 1 as bigint))) as i from labels)
  union all select page_id, fetched, host || '/' || seg, host from labels where seg != '') where host != ''),
n as (select max(page_id) + 1 as n from pages),
ev as (select distinct event_type as list, case when user_id % 2 = 0 then c.host else c.host || '/' || c.seg end as pattern,
    case when event_id % 3 = 0 then 'remove' else 'add' end as action, ts
  from events, n join caps c on c.page_id = (user_id * 31 + event_id) % n.n where c.host != ''),
st as (select list, pattern, ts, bool_and(action = 'add') as on_ from ev where pattern is not null group by all),
turn as (select *, lag(on_) over (partition by list, pattern order by ts) as was from st),
iv as (select * from (select list, pattern, ts, on_, lead(ts) over (partition by list, pattern order by ts) as till
  from turn where on_ != coalesce(was, false)) where on_),
hit as (select p.page_id, count(*) as n, min(p.pattern) as f from pats p join iv on p.pattern = iv.pattern
  and iv.ts <= p.fetched and (till is null or p.fetched < till) group by 1)
select c.page_id, c.fetched, cast(coalesce(n, 0) as bigint) as n_active, f as first_pattern, coalesce(n, 0) > 0 as blocked
from caps c left join hit using (page_id)
"""


@query("op9_temporal_url_filter", URL_SQL)
def temporal_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which of all pages were on a list when fetched.

    The given tables have neither fetch times nor dated lists, so both are derived from them: a page's
    fetch time from its id, and a list entry from every event, for the host (or the host and first path
    segment) of the page that the event's user and id point to.
    """
    second = F.pmod(F.col("page_id") * 7919, F.lit(2592000))
    pages = table(spark, sf_dir, "pages").select("page_id", "url", F.timestamp_add("second", second.cast("int"), F.lit("2024-01-01").cast("timestamp_ntz")).alias("fetched"))
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    named = pages.select("page_id", url_filters.host(F.col("url")).alias("host"), F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([^/?#]+)", 1).alias("seg"))
    pattern = F.when(F.col("user_id") % 2 == 0, F.col("host")).otherwise(F.concat_ws("/", "host", "seg"))
    action = F.when(F.col("event_id") % 3 == 0, "remove").otherwise("add")
    n = (pages.agg(F.max("page_id")).first()[0] or 0) + 1
    entries = events.join(named.where("host != ''"), F.col("page_id") == (F.col("user_id") * 31 + F.col("event_id")) % n)
    entries = entries.select(F.col("event_type").alias("list"), pattern.alias("pattern"), action.alias("action"), F.col("ts").cast("timestamp_ntz").alias("ts"))
    return url_filters.active_entries(pages, entries)


@query("op11_subword_classifier")
def subword_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents, learned from the labels of those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    return classifier.score(docs, classifier.fit(docs, table(spark, sf_dir, "labels")))


#: CRC-32 of the ASCII text k, bit by bit.
CRC_SQL = """xor(list_reduce(flatten(list_transform(string_split(k, ''), lambda x: [ascii(x), -1, -1, -1, -1, -1, -1, -1, -1]::bigint[])),
    lambda c, x: case when x >= 0 then xor(c, x) when c & 1 = 1 then xor(c >> 1, 3988292384::bigint) else c >> 1 end, 4294967295::bigint), 4294967295::bigint)"""

REPAIR_SQL = r"""
with recursive keyed as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as k from conversations),
kinds as (select *, {crc} % 20 as kind from keyed),
damaged as (select conv_id, turn, case kind when 4 then 'user' else role end as role,
    case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
  from kinds, (values (1), (2)) as twice(n) where kind != 0 and (n = 1 or kind = 3)),
placed as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as i from damaged),
again as (select *, row_number() over (partition by conv_id, role, text order by i) > 1 as again,
    lag(role) over (partition by conv_id order by i) as before, rtrim(text, E' \t\n\x0b\x0c\r') as kept from placed),
faults as (select *, kept = '' as blank, kept != '' and again as dup, kept != '' and not again and right(kept, 1) not in ('.', '!', '?') as cut,
    before is not null and left(before, 1) || ' ' || left(role, 1) not in ('s u', 'u a', 'a u') as bad from again),
counted as (select conv_id, cast(coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as bigint) as gaps, count(*) filter (blank) as blank,
    count(*) filter (dup) as duplicate, count(*) filter (cut) as truncated, count(*) filter (bad) as illegal, count(*) as n from faults group by conv_id),
dp as (
  select conv_id, n, 0::bigint as i, {'c': 0::bigint, 'a': '', 'r': []::varchar[]} as s0, {'c': 1000000000::bigint, 'a': '', 'r': []::varchar[]} as s1,
    {'c': 1000000000::bigint, 'a': '', 'r': []::varchar[]} as s2, {'c': 1000000000::bigint, 'a': '', 'r': []::varchar[]} as s3 from counted
  union all
  select conv_id, n, i,
    case when x then d0 else d0 end,
    list_min([d1, case when not x and l = 's' then {'c': t0.c + e, 'a': t0.a || 'K', 'r': list_append(t0.r, own)} else none end]),
    list_min([d2, case when x then none else {'c': t0.c + 3 + e, 'a': t0.a || 'R', 'r': list_append(t0.r, 'user:' || text)} end,
      case when x then none else {'c': t1.c + 3 + e, 'a': t1.a || 'R', 'r': list_append(t1.r, 'user:' || text)} end,
      case when x then none else {'c': t3.c + 3 + e, 'a': t3.a || 'R', 'r': list_append(t3.r, 'user:' || text)} end,
      case when not x and l = 'u' then {'c': t0.c + e, 'a': t0.a || 'K', 'r': list_append(t0.r, own)} else none end,
      case when not x and l = 'u' then {'c': t1.c + e, 'a': t1.a || 'K', 'r': list_append(t1.r, own)} else none end,
      case when not x and l = 'u' then {'c': t3.c + e, 'a': t3.a || 'K', 'r': list_append(t3.r, own)} else none end]),
    list_min([d3, case when x then none else {'c': t2.c + 3 + e, 'a': t2.a || 'R', 'r': list_append(t2.r, 'assistant:' || text)} end,
      case when not x and l = 'a' then {'c': t2.c + e, 'a': t2.a || 'K', 'r': list_append(t2.r, own)} else none end])
  from (select *, {'c': t0.c + 4, 'a': t0.a || 'D', 'r': t0.r} as d0, {'c': t1.c + 4, 'a': t1.a || 'D', 'r': t1.r} as d1,
      {'c': t2.c + 4, 'a': t2.a || 'D', 'r': t2.r} as d2, {'c': t3.c + 4, 'a': t3.a || 'D', 'r': t3.r} as d3,
      {'c': 1000000000::bigint, 'a': '', 'r': []::varchar[]} as none
    from (select d.conv_id, d.n, f.i, f.text, f.blank or f.dup as x, left(f.role, 1) as l, f.role || ':' || f.text as own, case when f.cut then 3 else 0 end as e,
        s0 as t0, s1 as t1,
        list_min([s2, {'c': s0.c + 3, 'a': s0.a || 'I', 'r': list_append(s0.r, 'user:')}, {'c': s1.c + 3, 'a': s1.a || 'I', 'r': list_append(s1.r, 'user:')},
          {'c': s3.c + 3, 'a': s3.a || 'I', 'r': list_append(s3.r, 'user:')}]) as t2,
        list_min([s3, {'c': s2.c + 3, 'a': s2.a || 'I', 'r': list_append(s2.r, 'assistant:')},
          {'c': s0.c + 6, 'a': s0.a || 'II', 'r': list_concat(s0.r, ['user:', 'assistant:'])}, {'c': s1.c + 6, 'a': s1.a || 'II', 'r': list_concat(s1.r, ['user:', 'assistant:'])}]) as t3
      from dp d join faults f on f.conv_id is not distinct from d.conv_id and f.i = d.i + 1))),
ends as (select conv_id, list_min([s0, s3, {'c': s2.c + 3, 'a': s2.a || 'I', 'r': list_append(s2.r, 'assistant:')},
    {'c': s1.c + 6, 'a': s1.a || 'II', 'r': list_concat(s1.r, ['user:', 'assistant:'])}]) as best from dp where i = n)
select c.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
  coalesce(illegal, 0) as illegal, coalesce(best.c, 0) as cost, coalesce(best.a, '') as audit, sha256(coalesce(array_to_string(best.r, chr(10)), '')) as repaired_sha256
from (select distinct conv_id from conversations) c left join counted n on n.conv_id is not distinct from c.conv_id
  left join ends e on e.conv_id is not distinct from c.conv_id
""".replace("{crc}", CRC_SQL)


WITH_PYTHON.add("op13_bidirectional_repair")


@query("op13_bidirectional_repair", REPAIR_SQL)
def bidirectional_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations with planted faults, and the cheapest repair of each."""
    damaged = conversations.damage(table(spark, sf_dir, "conversations"))
    return conversations.digests(conversations.repair(damaged))


MERKLE_SQL = r"""
with recursive fields as (select *, cast(doc_id as varchar) as k, coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') as a,
    coalesce(strlen(text) || ':' || text, '-') as z from documents),
hashed as (select doc_id, lang, sha256(coalesce(strlen(k) || ':' || k, '-') || a || coalesce(len(cast(n_chars as varchar)) || ':' || n_chars, '-') || z) as leaf,
    sha256(coalesce(strlen(k) || ':' || k, '-') || a || coalesce(len(cast(n_chars + case when {crc} % 7 = 0 then 1 else 0 end as varchar)) || ':'
      || (n_chars + case when {crc} % 7 = 0 then 1 else 0 end), '-') || z) as tampered from fields),
leaves as (select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as idx from hashed),
up as (select lang, 0 as level, list(leaf order by idx) as nodes from leaves group by lang
  union all select lang, level + 1, list_transform(range(0, (len(nodes) + 1) // 2), lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], ''))) from up where len(nodes) > 1),
subroots as (select lang, nodes[1] as subroot, row_number() over (order by lang nulls first) - 1 as idx from up where len(nodes) = 1),
top as (select 0 as level, list(subroot order by idx) as nodes from subroots
  union all select level + 1, list_transform(range(0, (len(nodes) + 1) // 2), lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], ''))) from top where len(nodes) > 1),
inner_nodes as (select lang, level, unnest(nodes) as h, unnest(range(len(nodes))) as i from up where len(nodes) > 1),
top_nodes as (select level, unnest(nodes) as h, unnest(range(len(nodes))) as i from top where len(nodes) > 1),
inner_steps as (select l.doc_id, l.lang, l.idx, list(case when (l.idx >> u.level) & 1 = 1 then 'L' else 'R' end || coalesce(n.h, '') order by u.level) as steps
  from leaves l join (select lang, level from up where len(nodes) > 1) u on l.lang is not distinct from u.lang
  left join inner_nodes n on n.lang is not distinct from l.lang and n.level = u.level and n.i = xor(l.idx >> u.level, 1::bigint) group by 1, 2, 3),
top_steps as (select s.lang, list(case when (s.idx >> t.level) & 1 = 1 then 'L' else 'R' end || coalesce(n.h, '') order by t.level) as steps
  from subroots s cross join (select level from top where len(nodes) > 1) t left join top_nodes n on n.level = t.level and n.i = xor(s.idx >> t.level, 1::bigint) group by 1),
every as (select l.doc_id, l.leaf, l.tampered, s.subroot, (select nodes[1] from top where len(nodes) = 1) as root, list_concat(coalesce(i.steps, []), coalesce(t.steps, [])) as steps
  from leaves l join subroots s on s.lang is not distinct from l.lang left join inner_steps i on i.lang is not distinct from l.lang and i.idx = l.idx
  left join top_steps t on t.lang is not distinct from l.lang)
select doc_id, leaf, subroot, root, sha256(coalesce(array_to_string(list_transform(steps, lambda x: x[2:]), ''), '')) as proof_sha256, folded_root, folded_root = root as verified
from (select *, list_reduce(steps, lambda h, x: sha256(case when x[1] = 'L' then x[2:] || h else h || x[2:] end), tampered) as folded_root from every)
""".replace("{crc}", CRC_SQL)


@query("op12_merkle_climb", MERKLE_SQL)
def merkle_climb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's proof, and whether its row folds to the root after one in seven has been tampered with."""
    docs = table(spark, sf_dir, "documents")
    more = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.col("n_chars").cast("decimal(20, 0)") + 1)
    fields = ("doc_id", "source", "lang")
    rows = docs.select("doc_id", "lang", merkle.leaf(*fields, "n_chars", "text").alias("leaf"), F.when(more.isNotNull(), merkle.leaf(*fields, more, "text")).alias("tampered"))
    rows = rows.withColumn("tampered", F.coalesce("tampered", "leaf"))
    return merkle.verify(rows, F.col("lang"), "tampered")
