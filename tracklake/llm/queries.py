"""The queries of this subpackage, with SQL where it can express them."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklake.llm import (
    hard_negatives, language, lexical, line_dedup, mixing, near_duplicates, pieces, quality_rules, repeats, token_files, topk, toxicity,
    vector_links,
)
from tracklake.llm.tables import read

QUERIES = {}
SQL = {}


def query(sql: str | None = None):
    def add(function):
        QUERIES[function.__name__] = function
        if sql:
            SQL[function.__name__] = sql
        return function

    return add


@query(r"""
with d as (select doc_id, source, coalesce(text, '') as t from documents),
w as (select doc_id, source, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as ws,
             list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as ls from d),
g as (select doc_id, i, array_to_string(ws[i:i+4], ' ') as gram
      from (select doc_id, ws, unnest(range(1, len(ws) - 3)) as i from w)),
r as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, gram) as k from g) where k > 1),
c as (select doc_id, count(distinct i + j) as n from r, (select unnest(range(0, 5)) as j) group by doc_id),
m as (select w.doc_id, source, len(ws)::bigint as n_words,
             length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::bigint as word_chars,
             (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
             (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines,
             coalesce(c.n, 0)::bigint as n_repeat_words
      from w left join c on w.doc_id = c.doc_id),
b as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from m),
h as (select source, count(*) as n, sum(base_failed::bigint) as f from b group by source),
p as (select sum(f) / sum(n)::double as mean, sum(n) as total, sum(n::double * n) as n2, count(*) - 1 as free from h),
s as (select any_value(mean) as mean, any_value(total) as total, any_value(n2) as n2, any_value(free) as free,
             sum(n * (f / n::double - mean) * (f / n::double - mean)) as s from h, p),
v as (select mean, 1 / least(greatest(case when mean * (1 - mean) * (total - n2 / total - free) > 0
        then (s - mean * (1 - mean) * free) / (mean * (1 - mean) * (total - n2 / total - free)) else 0.001 end,
        0.001), 0.5) - 1 as weight from s),
k as (select source, (f + weight * mean) / (n + weight) <= 0.5 as host_kept from h, v)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and host_kept as kept
from b join k on b.source is not distinct from k.source
""")
def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.judge(read(spark, folder, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query()
def op2_language_filters(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(read(spark, folder, "documents"))


def tokenizer_path(name: str) -> str:
    """Where the vocabulary files lie; the same on every machine."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


@query()
def op3_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = tokenizer_path("byte_bpe_50k.json")
    blocks = token_files.write(read(spark, folder, "documents"), path, end_id=2)
    return token_files.starts(token_files.documents(blocks, token_files.encoder(path).size))


@query()
def op4_piece_paths(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.encode(read(spark, folder, "documents"), tokenizer_path("piece_bpe_32k.model"), with_ids=True)


@query()
def op5_weighted_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates.classes(read(spark, folder, "documents"))


@query("""
with recursive n as (select source, count(*) as n from documents group by source),
t as (select sum(n) as rows, sum(sqrt(n::double)) as weight from n),
r as (select source, sqrt(n::double) / weight * rows / n as rate from n, t),
q as (select source, greatest(ceil(rate / 64.0), 1)::int as parts, rate / greatest(ceil(rate / 64.0), 1)::int as mean from r),
c(source, mean, k, p, total) as (
    select source, mean, 0, exp(-mean), exp(-mean) from q
    union all select source, mean, k + 1, p * mean / (k + 1), total + p * mean / (k + 1) from c where k < 160),
u as (select doc_id, documents.source, unnest(range(1, parts + 1)) as part
      from documents join q on documents.source is not distinct from q.source),
x as (select doc_id, u.source, ('0x' || substr(md5('7:' || part || ':' || doc_id), 1, 13))::bigint / 4503599627370496.0 as x from u),
d as (select doc_id, x.source, count(c.k) as n_copies
      from x left join c on x.source is not distinct from c.source and c.total <= x.x group by doc_id, x.source)
select doc_id, source, n_copies::int as n_copies, copy::int as copy,
       ('0x' || substr(md5('7/order:' || doc_id || ':' || copy), 1, 13))::bigint as shuffle_key
from (select doc_id, source, n_copies, unnest(range(1, n_copies + 1)) as copy from d)
""")
def op6_poisson_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(read(spark, folder, "documents"))
    return mixed.select("doc_id", "source", "n_copies", "copy", "shuffle_key")


@query()
def op7_string_kernel_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(read(spark, folder, "documents"), read(spark, folder, "labels"))


@query("""
with l as (select doc_id, source, generate_subscripts(ls, 1) as i, unnest(ls) as line
           from (select doc_id, source, string_split(text, chr(10)) as ls from documents)),
b as (select line from l where length(trim(line)) >= 20 group by line having count(distinct source) >= 10),
m as (select doc_id, l.line, i, b.line is not null as bad from l left join b on l.line = b.line),
s as (select doc_id, count(*) as n, count(*) filter (bad) as k, string_agg(line, chr(10) order by i) as whole,
             coalesce(string_agg(line, chr(10) order by i) filter (not bad), '') as rest,
             2 * coalesce(sum(length(trim(line))) filter (not bad), 0) >= sum(length(trim(line))) as applies
      from m group by doc_id)
select d.doc_id, coalesce(n, 0)::bigint as n_lines, (case when applies then k else 0 end)::bigint as n_removed,
       md5(case when applies then rest else whole end) as kept_md5
from documents d left join s on d.doc_id = s.doc_id
""")
def op8_line_spread(spark: SparkSession, folder: str) -> DataFrame:
    lines = line_dedup.remove(read(spark, folder, "documents"))
    return lines.select("doc_id", "n_lines", "n_removed", F.md5(F.col("text").cast("binary")).alias("kept_md5"))


@query()
def op9_suffix_repeats(spark: SparkSession, folder: str) -> DataFrame:
    rest = repeats.without_repeats(read(spark, folder, "documents"))
    return rest.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query("""
with v as (select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as v from embeddings
           where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id as query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::bigint as score
      from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 20 = 0)
select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score
from s qualify rank <= 20
""")
def op10_pivot_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top(read(spark, folder, "embeddings"), F.col("id") % 20 == 0)


@query("""
with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                  list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v from embeddings
           where label is not null and embedding is not null
             and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same,
             list_sum(list_transform(list_zip(a.v, c.v), lambda z: z[1] * z[2]))::bigint as score
      from v a join v c on a.vec_id <> c.vec_id where a.vec_id % 100 = 0),
p as (select anchor_id, vec_id as positive_id, score as positive_score,
             row_number() over (partition by anchor_id order by score desc, vec_id)::int as positive_rank
      from s where same qualify positive_rank <= 5)
select p.anchor_id, positive_id,
       row_number() over (partition by p.anchor_id, positive_rank order by score desc, vec_id)::int as rank,
       vec_id as negative_id, positive_score, score as negative_score, positive_rank
from p join s on p.anchor_id = s.anchor_id and not same
     and 80 * positive_score <= 100 * score and 100 * score <= 100 * positive_score
qualify rank <= 5
""")
def op11_subset_sum_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = read(spark, folder, "embeddings")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", shifted), F.col("id") % 100 == 0)


@query(r"""
with t as (select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as ws from benchmark),
i as (select item_id, unnest(list_distinct(ws)) as term from t),
d as (select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as ws from documents),
s as (select count(*)::bigint as n, sum(len(ws))::bigint as l from d where len(ws) > 0),
p as (select doc_id, 10 + (90 * len(ws) * s.n) // s.l as m, unnest(ws) as term from d, s),
f as (select doc_id, m, term, count(*) as tf from p where term in (select term from i) group by all),
w as (select term, floor(1000 * ln((2 * n + 2) / (2 * df + 1)::double))::bigint as w
      from (select term, count(*) as df from f group by term), s),
r as (select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint as score
      from i join w on i.term = w.term join f on i.term = f.term group by item_id, doc_id)
select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank, doc_id, score
from r where score > 0 qualify rank <= 10
""")
def op12_trie_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.search(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


@query("""
with recursive u as (select vec_id, list_transform(embedding, lambda x: x::double) as v from embeddings
           where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
             and len(list_filter(embedding, lambda x: x <> 0)) > 0),
l as (select a.vec_id as a, b.vec_id as b from u a join u b on a.vec_id <> b.vec_id
      where list_cosine_similarity(a.v, b.v) >= 0.95),
r(a, b) as (select a, b from l union select r.a, l.b from r join l on r.b = l.a),
c as (select a, least(a, min(b)) as component_id from r group by a),
k as (select a, count(*) as n from l group by a)
select vec_id, coalesce(n, 0)::bigint as n_links, coalesce(component_id, vec_id) as component_id,
       coalesce(component_id, vec_id) = vec_id as kept
from embeddings left join c on vec_id = c.a left join k on vec_id = k.a
""")
def op13_quantised_links(spark: SparkSession, folder: str) -> DataFrame:
    return vector_links.classes(read(spark, folder, "embeddings"))
