"""The operators over the whole test tables, and the SQL that must agree."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from cinetally.llm import decontaminate, exact_dedup, fill_in_middle, hard_negatives, language_model, licenses, near_dedup, ngram_join, pieces, quality, secret_scan, token_counts, toxicity
from cinetally.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)


def query(build: Query) -> Query:
    _QUERIES[build.__name__] = build
    return build


@query
def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.decisions(table(spark, folder, "documents")).drop("file", "row")


ORACLE["op1_exact_dedup"] = r"""
with d as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t from documents)
select doc_id, min(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
       doc_id = min(doc_id) over (partition by t) as kept, sha256(t) as text_sha256
from d
"""


@query
def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(table(spark, folder, "documents"))


@query
def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.score(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op8_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents")).drop("matches")


_VALUES = ", ".join(f"({i}, '{text}', '{label}')" for i, (text, label) in enumerate(licenses.TEMPLATES))
_PHRASES = ", ".join(f"('{text}', '{label}')" for text, label in licenses.PHRASES)
_WORDS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
ORACLE["op8_licenses"] = rf"""
with d as (
  select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
w as (select doc_id, regexp_extract_all(t, {_WORDS}) as words from d),
p as (select string_split(column0, ' ') as phrase, column1 as label from (values {_PHRASES}) v(column0, column1)),
s as (select doc_id, words, unnest(range(len(words))) as i from w where list_contains(words, 'license')),
places as (select doc_id, i, label from s, p where words[i + 1:i + len(phrase)] = phrase),
base as (select doc_id, count(*) as n, min(i) as first_word, max(i) as last_word, list(distinct label) as labels
         from places group by doc_id),
lines as (select doc_id, regexp_extract_all(unnest(string_split(t, chr(10))), {_WORDS}) as words from d),
blocks as (select doc_id, words, unnest(range(0, greatest(1, 1 + {licenses.BLOCK_STEP} * cast(ceil((len(words) - {licenses.BLOCK_WORDS}) / {licenses.BLOCK_STEP}) as bigint)), {licenses.BLOCK_STEP})) as b
           from lines where len(words) > 0),
t as (select list_distinct(string_split(column1, ' ')) as tokens, column2 as label from (values {_VALUES}) v(column0, column1, column2)),
c as (select doc_id, label, len(list_intersect(tokens, list_distinct(words[b + 1:b + {licenses.BLOCK_WORDS}]))) / len(tokens) as share
      from blocks, t),
m as (select doc_id, list(distinct label) as labels, max(share) as share from c
      where share >= {licenses.THRESHOLD} - 1e-9 group by doc_id)
select w.doc_id, len(words) as n_words, coalesce(n, 0) as n_base, first_word, last_word,
       coalesce(array_to_string(list_sort(base.labels), ','), '') as base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(m.labels, [])))), ','), '') as labels,
       case when n > 0 then 1.0::double else coalesce(share, 0)::double end as score
from w left join base using (doc_id) left join m using (doc_id)
"""


#: The words of the whole text as one more line.
ORACLE["op8_licenses"] = ORACLE["op8_licenses"].replace("from d),\nblocks", "from d union all select doc_id, words from w),\nblocks")


@query
def op6_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.scan(table(spark, folder, "documents"))


def _secret_sql() -> str:
    """Places by running lengths between matches; entropy of every window by the engine's own aggregate."""
    quoted = {k: "'" + p.replace("'", "''") + "'" for k, p in (
        ("assign", secret_scan.ASSIGN), ("access", secret_scan.ACCESS), ("hex", secret_scan.HEX), ("entropy", secret_scan.CANDIDATE),
    )}
    found = " union all ".join(
        f"select doc_id, {i} as kind, string_split_regex(t, {p}) as gaps, regexp_extract_all(t, {p}) as found, "
        + (f"regexp_extract_all(t, {p}, 2)" if k == "assign" else f"regexp_extract_all(t, {p})")
        + f" as vals from d where regexp_matches(t, {p})"
        for i, (k, p) in enumerate(quoted.items())
    )
    classes = " ".join(
        "when " + " and ".join(f"regexp_matches(f, '{p}')" for p in patterns) + f" then {least}::double"
        for _, patterns, least in secret_scan.CLASSES
    )
    allowed = " or ".join(f"regexp_matches(f, '{p}')" for p in secret_scan.ALLOWED)
    window = secret_scan.WINDOW
    names = "['assign','access','hex','entropy']"
    return rf"""
with d as (select doc_id, coalesce(text, '') as t from documents),
m as ({found}),
n as (select *, unnest(range(1, len(found) + 1)) as i from m),
s as (select doc_id, kind, found[i] as f, vals[i] as v,
        coalesce(list_sum(list_transform(gaps[1:i], lambda x: length(x))), 0)
        + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0) as start
      from n),
base as (select doc_id, kind, start, start + length(f) as stop from s
         where kind in (1, 2) or kind = 0 and length(v) >= {secret_scan.ASSIGN_CHARS}),
c as (select doc_id, start, f, case when {allowed} then null {classes} end as least from s where kind = 3),
w as (select doc_id, start, f, least, unnest(range(0, length(f) - {window} + 1)) as k from c where least is not null),
e as (select doc_id, 3 as kind, start + min(k) as start, start + max(k) + {window} as stop from w
      where list_aggregate(string_split(substring(f, k + 1, {window}), ''), 'entropy') >= least - {secret_scan.NEAR}
      group by doc_id, start, f),
b as (select doc_id, count(*) filter (kind = 0) as n_assign, count(*) filter (kind = 1) as n_access,
             count(*) filter (kind = 2) as n_hex,
             string_agg(concat({names}[kind + 1], ':', cast(start as bigint), ':', cast(stop as bigint)), ',' order by start, kind) as listed
      from base group by doc_id),
a as (select doc_id, count(*) filter (kind = 3) as n_entropy,
             string_agg(concat({names}[kind + 1], ':', cast(start as bigint), ':', cast(stop as bigint)), ',' order by start, kind) as listed
      from (from base union all from e) group by doc_id)
select d.doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
       sha256(coalesce(b.listed, '')) as base_sha256, coalesce(a.listed, '') as spans, coalesce(n_entropy, 0) as n_entropy
from d left join b using (doc_id) left join a using (doc_id)
"""


def _thorough_secret_sql() -> str:
    """The same over the stretches between allowed words."""
    forms = " or ".join(f"regexp_matches(f, '{p}')" for p in secret_scan.ALLOWED_FORMS)
    words = secret_scan.ALLOWED_WORDS
    stretches = f"""y as (select doc_id, start, string_split_regex(f, '{words}') as parts, list_concat([''], regexp_extract_all(f, '{words}')) as words
      from s where kind = 3 and not ({forms})),
z as (select *, unnest(range(1, len(parts) + 1)) as i from y),
q as (select doc_id, parts[i] as f, start + coalesce(list_sum(list_transform(parts[1:i - 1], lambda x: length(x))), 0)
        + coalesce(list_sum(list_transform(words[1:i], lambda x: length(x))), 0) as start from z),
c as ("""
    classes = " ".join(
        "when " + " and ".join(f"regexp_matches(f, '{p}')" for p in patterns) + f" then {least}::double"
        for _, patterns, least in secret_scan.CLASSES + secret_scan.LETTERS
    )
    before, _, rest = _secret_sql().partition("c as (")
    _, _, after = rest.partition("from s where kind = 3),")
    return f"{before}{stretches}select doc_id, start, f, case {classes} end as least from q where length(f) >= {secret_scan.WINDOW}),{after}"


ORACLE["op6_secrets"] = _thorough_secret_sql()


@query
def op4_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


ORACLE["op4_decontaminate"] = r"""
with i as (select distinct item_id, coalesce(text, '') as text from benchmark),
iw as (select item_id, row_number() over () as item, regexp_extract_all(lower(text), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from i),
ish as (select distinct item_id, item, least(5, len(w)) as k, array_to_string(w[p + 1:p + least(5, len(w))], ' ') as s
        from (select *, unnest(range(greatest(1, len(w) - 4))) as p from iw where len(w) > 0)),
isz as (select *, count(*) over (partition by item) as n from ish),
dw as (select doc_id, row_number() over () as doc, regexp_extract_all(lower(coalesce(text, '')), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
ks as (select distinct k from ish),
dsh as (select distinct doc_id, doc, k, array_to_string(w[p + 1:p + k], ' ') as s
        from (select *, unnest(range(greatest(0, len(w) - k + 1))) as p from dw, ks)),
m as (select doc_id, doc, item_id, item, n, count(*) as c from dsh join isz using (k, s) group by all)
select doc_id, item_id, c as n_shared, n as n_shingles, c / n as containment from m where c >= 0.8 * n - 1e-9
"""


@query
def op5_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.encode(table(spark, folder, "documents")).drop("text")


@query
def op3_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.classes(table(spark, folder, "documents"))


@query
def op9_language_model(spark: SparkSession, folder: str) -> DataFrame:
    return language_model.score(table(spark, folder, "documents"))


@query
def op12_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    return fill_in_middle.digests(fill_in_middle.transform(table(spark, folder, "documents")))


ORACLE["op12_fill_in_middle"] = r"""
with d as (select doc_id, coalesce(text, '') as t, sha256('1:' || cast(doc_id as varchar)) as h from documents),
u as (select doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') as w,
             ('0x' || h[1:8])::bigint as h1, ('0x' || h[9:16])::bigint as h2, ('0x' || h[17:24])::bigint as h3, ('0x' || h[25:32])::bigint as h4 from d),
c as (select doc_id, t, w, len(w)::bigint as n, least(h1 % (len(w) + 1), h2 % (len(w) + 1)) as a, greatest(h1 % (len(w) + 1), h2 % (len(w) + 1)) as b,
             case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90 then 'plain'
                  when h4 % 100 < 20 then 'spm' else 'psm' end as form from u),
p as (select doc_id, t, n, form, array_to_string(w[1:a], '') as prefix, array_to_string(w[a + 1:b], '') as middle, array_to_string(w[b + 1:], '') as suffix from c)
select doc_id, n, form, case when form <> 'plain' then length(prefix) end as prefix_chars, case when form <> 'plain' then length(middle) end as middle_chars,
       sha256(case form when 'plain' then t when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
       sha256(t) as restored_sha256
from p
"""


@query
def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


ORACLE["op11_hard_negatives"] = r"""
with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                  list_transform(embedding, lambda x: floor(256 * cast(x as double))) as e
           from embeddings
           where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
r as (select *, row_number() over () as node from v),
s as (select a.node as anchor, a.vec_id as anchor_id, b.node, b.vec_id as other_id, a.label = b.label as same, cast(list_dot_product(a.e, b.e) as bigint) as score
      from r a join r b on a.node <> b.node where a.vec_id % 100 = 0),
p as (select * from s where same qualify row_number() over (partition by anchor order by score desc, other_id) <= 5),
n as (select p.anchor, p.anchor_id, p.other_id as positive_id, p.score as positive_score, s.other_id as negative_id, s.score as negative_score,
             cast(row_number() over (partition by p.anchor, p.node order by s.score desc, s.other_id) as integer) as rank
      from p join s on p.anchor = s.anchor and not s.same and 80 * p.score <= 100 * s.score and s.score <= p.score)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from n where rank <= 5
"""


@query
def op13_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.link(table(spark, folder, "documents"))


ORACLE["op13_ngram_join"] = r"""
with recursive w as (
  select doc_id, row_number() over () as node,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
g as (select distinct node, array_to_string(w[i + 1:i + 4], ' ') as s from (select node, w, unnest(range(greatest(1, len(w) - 3))) as i from w where len(w) > 0)),
n as (select node, count(*) as n from g group by node),
t as (select node, n, list(s order by s) as grams from g join n using (node) group by node, n),
c as (select grams, min(node) as head, any_value(n) as n from t group by grams),
h as (select c.head, s from c join g on c.head = g.node),
p as (select a.head as a, b.head as b, count(*) as shared from h a join h b on a.s = b.s and a.head < b.head group by a.head, b.head),
l as (select p.a, p.b from p join c x on p.a = x.head join c y on p.b = y.head where 100 * shared >= 85 * (x.n + y.n - shared)),
e as (select a, b from l union all select b, a from l union all select head, head from c),
r as (select head as a, head as b from c union select r.a, e.b from r join e on r.b = e.a),
k as (select r.a as head, min(w.doc_id) as component_id from r join c on r.b = c.head join t on t.grams = c.grams join w on w.node = t.node group by r.a)
select w.doc_id, coalesce(t.n, 0) as n_shingles, coalesce(k.component_id, w.doc_id) as component_id
from w left join t using (node) left join c on t.grams = c.grams left join k on k.head = c.head
"""
