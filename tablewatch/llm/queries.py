"""The registered query of each corpus operator, with oracle SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewatch.llm import order_minhash, prefix_trie, quality
from tablewatch.llm.common import prepare
from tablewatch.llm.decontaminate import find_benchmark
from tablewatch.llm.lexical_search import search
from tablewatch.llm.line_dedup import remove_repeated_lines
from tablewatch.llm.minhash_dedup import near_duplicates
from tablewatch.llm.neighbour_graph import near_duplicate_vectors
from tablewatch.llm.packing import pack_documents
from tablewatch.llm.substring_dedup import remove_repeats
from tablewatch.llm.suffix_dedup import remove_repeated_bytes
from tablewatch.llm.token_counts import count_tokens
from tablewatch.llm.toxicity import toxicity

#: The vocabulary of the token queries; a parameter of their operators.
VOCABULARY = "byte_bpe_50k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


#: A-Z lower-cased, nothing else.
FOLDED_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def vocabulary() -> str:
    import public_tokenizers
    return str(public_tokenizers.path(VOCABULARY))


def sha256_of(text: str):
    return F.sha2(F.encode(text, "UTF-8"), 256)


@query("op1_embedding_near_dedup", r"""
with recursive v as (select vec_id, cast(embedding as double[]) as e from embeddings),
links as (select a.vec_id as u, b.vec_id as w from v a join v b on a.vec_id <> b.vec_id
          where list_cosine_similarity(a.e, b.e) >= 0.9),
reach(vec_id, other) as (select vec_id, vec_id from v union select r.vec_id, l.w from reach r join links l on l.u = r.other)
select vec_id, cast((select count(*) from links where u = c.vec_id) as bigint) as n_links, component_id, vec_id = component_id as kept
from (select vec_id, min(other) as component_id from reach group by vec_id) c
""")
def op1(spark, sf_dir):
    return near_duplicate_vectors(read(spark, sf_dir, "embeddings"), threshold=0.9).drop("audited_recall")


@query("op2_quality_classifier")
def op2(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return quality.classify(docs, quality.learn(docs))


@query("op3_suffix_array_dedup")
def op3(spark, sf_dir):
    out = remove_repeated_bytes(read(spark, sf_dir, "documents"), length=200)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op4_substring_dedup", r"""
with w as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
win as (select doc_id, i, md5(array_to_string(ws[i:i + 34], ' ')) as h
        from (select doc_id, ws, unnest(range(1, len(ws) - 33)) as i from w where len(ws) >= 35)),
rep as (select doc_id, i from (select doc_id, i, count(*) over (partition by h) as n from win) where n > 1),
gone as (select distinct doc_id, unnest(range(i, i + 35)) as j from rep),
words as (select doc_id, unnest(ws) as word, generate_subscripts(ws, 1) as j from w),
kept as (select k.doc_id, string_agg(k.word, ' ' order by k.j) as text
         from words k anti join gone g on k.doc_id = g.doc_id and k.j = g.j group by k.doc_id)
select w.doc_id, cast(len(ws) as bigint) as n_words,
       cast(coalesce(g.n, 0) as bigint) as n_removed, sha256(coalesce(k.text, '')) as kept_sha256
from w left join kept k using (doc_id)
left join (select doc_id, count(*) as n from gone group by doc_id) g using (doc_id)
""")
def op4(spark, sf_dir):
    out = remove_repeats(read(spark, sf_dir, "documents"), window=35)
    return out.select("doc_id", "n_words", "n_removed", sha256_of("text").alias("kept_sha256"))


@query("op5_token_counts")
def op5(spark, sf_dir):
    return count_tokens(read(spark, sf_dir, "documents"), vocabulary(), limit=512)


@query("op6_benchmark_decontamination", rf"""
with iw as (select item_id, regexp_extract_all({FOLDED_SQL}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from benchmark),
dw as (select doc_id, regexp_extract_all({FOLDED_SQL}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from documents),
iwin as (select distinct item_id, size, array_to_string(ws[i:i + size - 1], ' ') as win
         from (select item_id, ws, size, unnest(range(1, len(ws) - size + 2)) as i
               from (select *, least(10, len(ws)) as size from iw where len(ws) > 0))),
dwin as (select doc_id, i, size, array_to_string(ws[i:i + size - 1], ' ') as win
         from (select doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) as i
               from dw join (select distinct size from iwin) on len(ws) >= size)),
hits as (select doc_id, i, d.size, item_id from dwin d join iwin w on d.size = w.size and d.win = w.win),
words as (select doc_id, count(distinct j) as n from (select doc_id, unnest(range(i, i + size)) as j from hits) group by 1),
items as (select doc_id, count(*) as n, string_agg(item, ',' order by item) as names
          from (select distinct doc_id, cast(item_id as varchar) as item from hits) group by 1)
select dw.doc_id, cast(len(ws) as bigint) as n_words, cast(coalesce(words.n, 0) as bigint) as n_hit,
       cast(coalesce(items.n, 0) as bigint) as n_items, sha256(coalesce(items.names, '')) as items_sha256,
       coalesce(words.n, 0) > 0 as contaminated
from dw left join words using (doc_id) left join items using (doc_id)
""")
def op6(spark, sf_dir):
    out = find_benchmark(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), n=10)
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.encode(F.array_join("items", ","), "UTF-8"), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))


@query("op7_minhash_near_dedup", rf"""
with recursive w as (select doc_id, regexp_extract_all({FOLDED_SQL}, '[^\x20\x09-\x0D]+') as ws from documents),
s as (select distinct doc_id, array_to_string(ws[i:i + 3], ' ') as shingle
      from (select doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) as i from w where len(ws) > 0)),
n as (select doc_id, count(*) as n from s group by 1),
common as (select a.doc_id as u, b.doc_id as v, count(*) as c
           from s a join s b on a.shingle = b.shingle and a.doc_id <> b.doc_id group by 1, 2),
links as (select u, v from common join n x on x.doc_id = u join n y on y.doc_id = v where 100 * c >= 80 * (x.n + y.n - c)),
reach(doc_id, other) as (select doc_id, doc_id from w union select r.doc_id, l.v from reach r join links l on l.u = r.other)
select r.doc_id, cast(coalesce(max(n.n), 0) as bigint) as n_shingles, min(other) as component_id, r.doc_id = min(other) as kept
from reach r left join n on n.doc_id = r.doc_id group by r.doc_id
""")
def op7(spark, sf_dir):
    out = near_duplicates(read(spark, sf_dir, "documents"), words=4, percent=80)
    return out.select("doc_id", "n_shingles", "component_id", "kept")


@query("op8_line_dedup")
def op8(spark, sf_dir):
    out = remove_repeated_lines(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", sha256_of("text").alias("kept_sha256"))


@query("op9_best_fit_packing")
def op9(spark, sf_dir):
    return pack_documents(read(spark, sf_dir, "documents"), vocabulary(), capacity=1024, end_id=2)


@query("op10_toxicity")
def op10(spark, sf_dir):
    return toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), threshold=0.7)


#: CRC-32 over a conversation id's decimal digits, a table look-up a byte.
TREE_SQL = """
with recursive steps(b, i, c) as (select range, 0, range from range(256)
    union all select b, i + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end from steps where i < 8),
tab as (select list(c order by b) as t from steps where i = 8),
own as (select conv_id, list(struct_pack(k := md5(concat(octet_length(encode(coalesce(role, ''))), ':', coalesce(role, ''), coalesce(text, ''))),
                                         b := octet_length(encode(coalesce(text, '')))) order by turn nulls first) as turns
        from conversations where conv_id is not null group by conv_id),
numbered as (select conv_id, turns, conv_id - conv_id % 5 as base,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(cast(conv_id as varchar), ''), lambda x: cast(ascii(x) as bigint))),
                    lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 9 as h from own, tab),
seqs as (select n.conv_id, list_concat(coalesce(o.turns[1:n.h], []), n.turns[n.h + 1:]) as turns from numbered n left join own o on o.conv_id = n.base),
keyed as (select conv_id, list_transform(turns, lambda x: x.k) as ks, list_transform(turns, lambda x: x.b) as bs from seqs),
walk as (select conv_id, len(ks) as total, d, array_to_string(ks[1:d], ',') as path, case when d > 0 then array_to_string(ks[1:d - 1], ',') end as up,
                case when d > 0 then bs[d] else 0 end as bytes
         from (select *, unnest(range(0, len(ks) + 1)) as d from keyed)),
nodes as (select path, d as depth, any_value(up) as up, any_value(bytes) as bytes, min(conv_id) as conv_id, count(*) as n,
                 coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (total = d), '') as ends from walk group by path, d),
kids as (select p.path, p.depth, count(c.path) as n_children from nodes p left join nodes c on c.up = p.path and c.depth = p.depth + 1 group by 1, 2),
tops as (select n.path, n.depth, n.bytes, n.n, k.n_children, unnest(range(0, n.depth + 1)) as above, string_split(n.path, ',') as ks
         from nodes n join kids k on k.path = n.path and k.depth = n.depth),
sums as (select array_to_string(ks[1:above], ',') as path, above as depth, count(*) filter (n_children = 0) as n_leaves, sum((n - 1) * bytes) as saved
         from tops group by 1, 2)
"""


@query("op11_conversation_prefix_trie", TREE_SQL + """
select n.conv_id, cast(n.depth as bigint) as depth, p.conv_id as parent_conv_id, n.n as n_convs, k.n_children, s.n_leaves,
       cast(s.saved as bigint) as saved_tokens, sha256(n.ends) as ends_sha256
from nodes n join kids k on k.path = n.path and k.depth = n.depth join sums s on s.path = n.path and s.depth = n.depth
left join nodes p on p.path = n.up and p.depth = n.depth - 1
""")
def op11(spark, sf_dir):
    convs = prefix_trie.conversations(read(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_tree(prefix_trie.rebuilt(convs, family=5, most=9))


@query("op12_document_fingerprints")
def op12(spark, sf_dir):
    out = order_minhash.fingerprints(read(spark, sf_dir, "documents"), k=2, size=2, points=64, third=3)
    return out.select("doc_id", "n_chars", sha256_of("edited").alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next")


TERMS_SQL = r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'"


@query("op13_ranked_lexical_search", rf"""
with dt as (select doc_id, unnest(regexp_extract_all({FOLDED_SQL}, {TERMS_SQL})) as term from documents),
n as (select doc_id, count(*) as n from dt group by 1),
al as (select count(*) as n_all, cast(sum(n) as bigint) as len_all from n),
m as (select doc_id, 100 - 90 + ((90 * n * n_all) // len_all) as m from n, al),
it as (select distinct item_id, unnest(regexp_extract_all({FOLDED_SQL}, {TERMS_SQL})) as term from benchmark),
tf as (select doc_id, term, count(*) as tf from dt where term in (select term from it) group by 1, 2),
w as (select term, cast(floor(1000 * ln((2 * n_all + 2) / (2 * count(*) + 1))) as bigint) as w from tf, al group by term, n_all),
sc as (select item_id, doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) as bigint) as score
       from it join tf using (term) join w using (term) join m using (doc_id) group by 1, 2),
rk as (select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as int) as rank, doc_id, score from sc where score > 0)
select * from rk where rank <= 10
""")
def op13(spark, sf_dir):
    return search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), top=10)
