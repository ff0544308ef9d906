"""The registered queries of the corpus operators, and their SQL where DuckDB can express it on whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import cube_mix, fm_index, hilbert, html_blocks, hyper_minhash, induced_suffixes, jaccard_skip, kn_langid, line_runs, minhash_contain, phrase_trie, prefix_fp, turn_trie
from .common import documents


def _sha(text: str = "text") -> Column:
    return F.sha2(F.col(text), 256)


def op1_substring_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = fm_index.remove_seen(documents(spark, sf_dir), window=50)
    return kept.select("doc_id", "n_words", "n_removed", _sha().alias("kept_sha256"))


def op2_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_runs.drop_frequent_lines(documents(spark, sf_dir), min_docs=10, min_chars=1)
    return kept.select("doc_id", "n_lines", "n_dropped", _sha().alias("kept_sha256"))


def op3_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = hilbert.shard_documents(documents(spark, sf_dir), n_shards=8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op5_induced_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = induced_suffixes.remove_repeats(documents(spark, sf_dir), window=200)
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", _sha("body").alias("kept_sha256"))


def op6_jaccard_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_skip.linked_documents(documents(spark, sf_dir), k=4, percent=85)


def op7_minhash_contain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_contain.contained(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), k=5, least=0.8)


def op8_kn_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = kn_langid.train(docs, ~held_out)
    return kn_langid.identify(docs, model).select("doc_id", (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2).alias("held_out"), "lang_pred", "score", "rejected")


def op9_cube_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = cube_mix.mix_sources(documents(spark, sf_dir), weights=(5, 2, 1), share=1.5, cap=2.0)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op10_prefix_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_fp.fingerprints_with_edits(documents(spark, sf_dir))


def op11_turn_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_trie.prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet")).drop("node")


def op12_phrase_tries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_trie.collocations(documents(spark, sf_dir), least=100, longest=5, top=2000)


def op13_hyper_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyper_minhash.near_duplicates(documents(spark, sf_dir), k=3, percent=85)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_substring_fm, op2_line_runs, op3_hilbert_shards, op4_html_blocks, op5_induced_suffixes, op6_jaccard_skip, op7_minhash_contain, op8_kn_language, op9_cube_mix, op10_prefix_fingerprints, op11_turn_trie, op12_phrase_tries, op13_hyper_minhash, pipeline)}

_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

ORACLES = {
    "op2_line_runs": r"""
with l as (
  select rowid_ as r, doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
  from (select *, row_number() over () as rowid_ from documents)),
k as (select *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from l),
f as (select key from k where key <> '' group by key having count(distinct r) >= 10)
select doc_id, count(*) as n_lines, count(f.key) as n_dropped,
       sha256(coalesce(string_agg(case when f.key is null then line end, chr(10) order by pos), '')) as kept_sha256
from k left join f on k.key = f.key group by r, doc_id""",
    "op1_substring_fm": rf"""
with d as (select doc_id, {_WORDS} as w from documents),
v as (select doc_id, w, unnest(range(1, greatest(len(w) - 48, 1))) as i from d where len(w) >= 50),
h as (select doc_id, i, md5(array_to_string(list_slice(w, i, i + 49), ' ')) as k from v),
m as (select doc_id, i, min(doc_id) over (partition by k) as first_doc from h),
c as (select distinct doc_id, i + o as p from (select doc_id, i from m where first_doc < doc_id), range(0, 50) t(o)),
x as (select doc_id, unnest(w) as word, generate_subscripts(w, 1) as p from d),
y as (select x.doc_id, x.p, x.word, c.p is not null as gone from x left join c on x.doc_id = c.doc_id and x.p = c.p),
g as (select doc_id, count(*) filter (gone) as n_removed, string_agg(case when not gone then word end, ' ' order by p) as kept from y group by doc_id)
select d.doc_id, cast(len(d.w) as bigint) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from d left join g on d.doc_id = g.doc_id""",
    "op7_minhash_contain": rf"""
with b as (select item_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from benchmark where text is not null),
s as (select item_id, least(5, len(w)) as k, unnest(list_distinct(list_transform(range(1, len(w) - least(5, len(w)) + 2), lambda i: array_to_string(list_slice(w, i, i + least(5, len(w)) - 1), ' ')))) as g from b where len(w) > 0),
n as (select item_id, count(*) as n_item from s group by item_id),
d as (select doc_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents where text is not null),
t as (select doc_id, k, unnest(list_distinct(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(list_slice(w, i, i + k - 1), ' ')))) as g
      from d, (select distinct k from s) where len(w) >= k),
c as (select doc_id, s.item_id, count(*) as n_shared from t join s on t.g = s.g and t.k = s.k group by doc_id, s.item_id)
select doc_id, c.item_id, n_item, n_shared, n_shared / n_item as containment from c join n on c.item_id = n.item_id where n_shared >= 0.8 * n_item""",
    "op11_turn_trie": r"""
with t as (select conv_id, turn, md5(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) as k, length(coalesce(text, '')) as n from conversations where conv_id is not null),
o as (select conv_id, list({'k': k, 'n': n} order by turn nulls first, k) as own from t group by conv_id),
h as (select conv_id, own, conv_id - conv_id % 100 as base, cast(xor(list_reduce(list_concat([4294967295], flatten(list_transform(string_split(cast(conv_id as varchar), ''), lambda c: [ascii(c), -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda x, y: case when y >= 0 then xor(x, y) when x % 2 = 1 then xor(x // 2, 3988292384) else x // 2 end), 4294967295) % 6 as int) as h from (select conv_id, own from o)),
r as (select h.conv_id, list_concat(coalesce(list_slice(b.own, 1, h), []), coalesce(list_slice(h.own, h + 1, len(h.own)), [])) as seq from h left join o b on b.conv_id = h.base),
p as (select conv_id, d as depth, array_to_string(list_transform(list_slice(seq, 1, d), lambda x: x.k), '/') as path, case when d > 0 then seq[d].n else 0 end as n, len(seq) as total from (select *, unnest(range(0, len(seq) + 1)) as d from r)),
g as (select path, depth, min(conv_id) as conv_id, count(*) as n_convs, any_value(n) as n, coalesce(string_agg(case when total = depth then cast(conv_id as varchar) end, ',' order by conv_id), '') as ends from p group by path, depth),
u as (select *, substr(path, 1, cast(greatest(33 * depth - 34, 0) as bigint)) as up from g),
c as (select up, count(*) as n_children from u where depth > 0 group by up),
v as (select u.*, coalesce(c.n_children, 0) as n_children from u left join c on c.up = u.path),
s as (select substr(path, 1, cast(greatest(33 * a - 1, 0) as bigint)) as anc, count(*) filter (n_children = 0) as n_leaves, cast(sum((n_convs - 1) * n) as bigint) as saved from (select *, unnest(range(0, depth + 1)) as a from v) group by anc)
select v.conv_id, v.depth, w.conv_id as parent_conv_id, v.n_convs, v.n_children, s.n_leaves, s.saved as saved_tokens, sha256(v.ends) as ends_sha256
from v join s on s.anc = v.path left join v w on v.depth > 0 and w.path = v.up""",
    "op12_phrase_tries": r"""
with d as (select coalesce(lang, 'und') as lang, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents where text is not null),
p as (select lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) as piece from d),
w as (select lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') as w from p),
g as (select lang, k, unnest(list_transform(range(1, cast(len(w) - k + 2 as bigint)), lambda i: array_to_string(list_slice(w, i, i + k - 1), ' '))) as phrase from w, (select unnest(range(1, 6)) as k) where len(w) >= k),
n as (select lang, count(*) as n from g where k = 1 group by lang),
f as (select lang, k, phrase, count(*) as a from g group by lang, k, phrase having count(*) >= 100),
c as (select lang, k, phrase, a, unnest(range(1, k)) as cut, string_split(phrase, ' ') as w from f where k > 1),
s as (select c.lang, c.phrase, c.k, c.a, cut, l.a as l, r.a as r, n.n, cast((1000::hugeint * c.a * n.n) // (l.a::hugeint * r.a) as bigint) as score
      from c join f l on l.lang = c.lang and l.phrase = array_to_string(list_slice(c.w, 1, cut), ' ') join f r on r.lang = c.lang and r.phrase = array_to_string(list_slice(c.w, cut + 1, c.k), ' ') join n on n.lang = c.lang),
b as (select * from (select *, row_number() over (partition by lang, phrase order by score, cut) as o from s) where o = 1),
i as (select lang, a, unnest(range(2, k)) as m, k, string_split(phrase, ' ') as w from f where k > 2),
j as (select lang, max(a) as longer, sub from (select lang, a, unnest(list_transform(range(1, k - m + 2), lambda x: array_to_string(list_slice(w, x, x + m - 1), ' '))) as sub from i) group by lang, sub),
z as (select b.* from b left join j on j.lang = b.lang and j.sub = b.phrase where coalesce(100 * longer < 100 * b.a, true))
select lang, rank, phrase, a, l, r, n, score from (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from z) where rank <= 2000""",
    "op13_hyper_minhash": r"""
with recursive d as (select doc_id, row_number() over () as r, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
s as (select doc_id, r, list_sort(list_distinct(list_transform(range(1, greatest(len(w) - 2, 1) + 1), lambda i: array_to_string(list_slice(w, i, i + 2), ' ')))) as g, len(w) as words from d),
k as (select r, doc_id, case when words = 0 then 0 else len(g) end as n, case when words = 0 then 'none' || r else md5(array_to_string(g, chr(10))) end as key, g, words from s),
u as materialized (select key, any_value(n) as n, any_value(g) as g, min(doc_id) as least from k where words > 0 group by key),
e as materialized (select key, n, unnest(g) as x from u),
o as (select x from e group by x having count(*) > 1),
q as (select e.key, e.n, e.x from e join o on e.x = o.x),
p as materialized (select a.key as a, b.key as b from q a join q b on a.x = b.x and a.key <> b.key and b.n * 100 >= 85 * a.n and a.n * 100 >= 85 * b.n group by a.key, b.key, a.n, b.n having 100 * count(*) >= 85 * (a.n + b.n - count(*))),
c as (select key, key as top from u union select p.b, c.top from c join p on p.a = c.key),
t as (select key, min(top) as top from c group by key),
m as (select t.top, min(least) as component_id from t join u on u.key = t.key group by t.top)
select k.doc_id, cast(k.n as bigint) as n_shingles, coalesce(m.component_id, k.doc_id) as component_id, coalesce(m.component_id, k.doc_id) = k.doc_id as kept from k left join t on t.key = k.key left join m on m.top = t.top""",
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
