"""The dealt operators as named queries over whole tables, with SQL twins where SQL can say them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import (
    cap_filters,
    dac,
    decontam,
    importance,
    lang_cnn,
    merkle,
    near_dups,
    orchard,
    pii,
    prefix_trie,
    sp_codec,
    url_filter,
    warc,
)
from tablewright.llm.common import read_table
from tablewright.llm.registry import ORACLES, QUERIES, query
from tablewright.session import materialize, scratch_path

__all__ = ["ORACLES", "QUERIES"]

URL_RULES = [
    url_filter.Rule("net/", "block"),
    url_filter.Rule("example.net/en/", "allow"),
    url_filter.Rule("example.com/de/", "block"),
    url_filter.Rule("org/fr/", "allow"),
]


@query()
def op1_url_words(spark: SparkSession, folder: str) -> DataFrame:
    """Rule or naive Bayes verdict on every page's url; names are split by the words of all documents."""
    return url_filter.judge_urls(read_table(spark, folder, "pages"), read_table(spark, folder, "documents"), URL_RULES)


@query()
def op2_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every document: matches of the patterns, and what the network adds."""
    docs = read_table(spark, folder, "documents")
    found = pii.detect(docs, pii.learn(docs), "doc_id")
    counts = [F.regexp_count("base", F.lit(kind)).cast("long").alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")


@query()
def op3_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Piece ids of every document by the streaming Viterbi, and whether decoding gives the text back."""
    docs = read_table(spark, folder, "documents")
    return sp_codec.encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"), "doc_id", ids=False)


@query()
def op4_byte_cnn(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, by a network that learns from the documents that are not held out."""
    docs = read_table(spark, folder, "documents")
    found = lang_cnn.identify(docs, lang_cnn.learn_languages(docs), "doc_id")
    return found.select("doc_id", lang_cnn.held_out(found).alias("held_out"), "lang_pred", "score")


@query("""
with p as (select page_id, coalesce(html, '') as html from pages),
     d as (select page_id, strlen(html) as n, sha256(html) as digest from p),
     f as (select digest, min(page_id) as first from d group by digest)
select d.page_id, d.n as payload_bytes, d.digest as payload_digest,
       case when d.n >= 100 and d.page_id > f.first then 'revisit' else 'response' end as record_type,
       case when d.n >= 100 and d.page_id > f.first then f.first end as refers_to
from d join f using (digest)
""")
def op5_warc_salvage(spark: SparkSession, folder: str) -> DataFrame:
    """Every page written as a WARC record and read back by the salvaging reader."""
    path = scratch_path(spark, "warc")
    warc.write_warc(read_table(spark, folder, "pages"), path)
    records = warc.read_warc(spark, path, payloads=False).filter("status != 'quarantined'")
    return records.select(
        "page_id", "payload_bytes", "payload_digest", F.col("kind").alias("record_type"), "refers_to"
    )


@query()
def op6_merkle(spark: SparkSession, folder: str) -> DataFrame:
    """Merkle fingerprints of every document and of its edited text, and how alike they are."""
    return merkle.fingerprint_edits(read_table(spark, folder, "documents"))


@query()
def op7_importance(spark: SparkSession, folder: str) -> DataFrame:
    """Importance weight of every document towards those of good quality, and a sample of a tenth of them."""
    good = read_table(spark, folder, "labels").filter("quality = 1")
    return importance.resample(read_table(spark, folder, "documents"), good, share=0.1)


@query(r"""
with recursive word as (
       select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x20\x09-\x0D]+') as w from documents),
     shingle as materialized (
       select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
              else [array_to_string(w[i : i + 4], ' ') for i in range(1, len(w) - 3)] end) as s from word),
     size as materialized (select doc_id, count(*) as n from shingle group by doc_id),
     common as (select a.doc_id as a, b.doc_id as b, count(*) as k
              from shingle a join shingle b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
     link as materialized (
       select a, b from common join size x on x.doc_id = a join size y on y.doc_id = b where 100 * k >= 75 * (x.n + y.n - k)),
     edge as materialized (select a, b from link union select b, a from link),
     reach as (select doc_id, doc_id as r from documents union select reach.doc_id, edge.b from reach join edge on edge.a = reach.r)
select d.doc_id, coalesce(n, 0) as n_shingles, c.component_id, d.doc_id = c.component_id as kept
from documents d left join size on size.doc_id = d.doc_id
     join (select doc_id, min(r) as component_id from reach group by doc_id) c on c.doc_id = d.doc_id
""")
def op8_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """The component of every document under links of 75 % shared 5-word shingles."""
    return near_dups.near_duplicates(read_table(spark, folder, "documents"))


_ITEM_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(f"""
with item as (select item_id, {_ITEM_WORDS} as w from benchmark),
     win as (select item_id, least(len(w), 10) as n,
                    unnest([array_to_string(w[i : i + 9], ' ') for i in range(1, greatest(len(w) - 9, 1) + 1)]) as win
             from item where len(w) > 0),
     size as materialized (select distinct n from win),
     doc as materialized (select doc_id, {_ITEM_WORDS} as w from documents),
     place as (select doc_id, n, unnest(range(1, len(w) - n + 2)) as pos, w from doc, size where len(w) >= n),
     hit as materialized (
       select p.doc_id, p.pos, p.n, win.item_id
       from (select doc_id, n, pos, array_to_string(w[pos : pos + n - 1], ' ') as win from place) p
       join win on p.win = win.win and p.n = win.n),
     words as (select doc_id, count(distinct x) as n_hit
               from (select doc_id, unnest(range(pos, pos + n)) as x from hit) group by doc_id),
     items as (select doc_id, count(*) as n_items, string_agg(id, ',' order by id) as ids
               from (select distinct doc_id, cast(item_id as varchar) as id from hit) group by doc_id)
select doc.doc_id, len(doc.w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from doc left join words using (doc_id) left join items using (doc_id)
""")
def op9_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document that lie in a passage of the benchmark, and the items they come from."""
    found = decontam.contamination(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query()
def op10_direct_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every document written as directly addressable codes and read back."""
    path = scratch_path(spark, "codes")
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    dac.write_codes(read_table(spark, folder, "documents"), path, tokenizer, end_id=2, special_tokens=True)
    return dac.read_documents(spark, path)


@query("""
with recursive vec as materialized (
       select vec_id, list_transform(embedding, lambda x: x::double) as v from embeddings
       where embedding is not null and len(embedding) > 0 and not list_contains(list_transform(embedding, lambda x: x is null), true)
             and list_bool_and(list_transform(embedding, lambda x: isfinite(x))) and list_bool_or(list_transform(embedding, lambda x: x <> 0))),
     link as materialized (
       select a.vec_id as a, b.vec_id as b from vec a join vec b
       on a.vec_id <> b.vec_id and len(a.v) = len(b.v) where list_cosine_similarity(a.v, b.v) >= 0.95),
     reach as (select vec_id, vec_id as r from embeddings union select reach.vec_id, link.b from reach join link on link.a = reach.r),
     degree as (select a, count(*) as n from link group by a)
select e.vec_id, coalesce(n, 0) as n_links, c.component_id, e.vec_id = c.component_id as kept
from embeddings e left join degree on degree.a = e.vec_id
     join (select vec_id, min(r) as component_id from reach group by vec_id) c on c.vec_id = e.vec_id
""")
def op11_cap_filters(spark: SparkSession, folder: str) -> DataFrame:
    """The component of every vector under links of a cosine of 0.95 or more, and its number of links."""
    return cap_filters.near_vectors(read_table(spark, folder, "embeddings"))


def _orchard_sql(rounds: int) -> str:
    """k-means in integers: each round's centroids c<i> from the assignment to those before."""
    nearest = (
        "select k.vec_id, k.v, min({{'d': list_sum(list_transform(range(1, 65), lambda i: (k.v[i] - c.v[i]) * (k.v[i] - c.v[i]))), "
        "'c': c.c}}) as m from kept k, c{0} c group by k.vec_id, k.v"
    )
    steps = []
    for i in range(rounds):
        steps.append(f"a{i} as materialized ({nearest.format(i)})")
        steps.append(
            f"s{i} as (select c, i, sum(x)::bigint as s, count(*) as n from (select m.c as c, unnest(range(1, 65)) as i, unnest(v) as x from a{i}) group by c, i)"
        )
        steps.append(
            f"c{i + 1} as materialized (select c.c, coalesce(t.v, c.v) as v from c{i} c left join "
            f"(select c, list((s - ((s % n) + n) % n) // n order by i) as v from s{i} group by c) t using (c))"
        )
    return ", ".join(steps) + f", last as materialized ({nearest.format(rounds)})"


@query(f"""
with kept as materialized (
       select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as v from embeddings
       where len(embedding) = 64 and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x)))),
     c0 as materialized (
       select row_number() over (order by sha256('1:' || vec_id))::int - 1 as c, v from kept qualify c < 16),
     {_orchard_sql(3)}
select vec_id, m.c::int as cluster, m.d::bigint as distance, sum(m.d) over (partition by m.c)::bigint as cluster_inertia,
       sum(m.d) over ()::bigint as inertia, sha256(array_to_string(c.v, ',')) as centroid_sha256
from last join c3 c on c.c = m.c
""")
def op12_orchard(spark: SparkSession, folder: str) -> DataFrame:
    """The cluster of every vector after three rounds of exact integer k-means with 16 centroids."""
    return orchard.cluster(read_table(spark, folder, "embeddings"))


@query("""
with turn as (select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
                     row_number() over (partition by conv_id order by turn nulls first) as i from conversations where conv_id is not null),
     conv as (select conv_id, list({'r': role, 't': text} order by i) as s, conv_id - conv_id % 100 as head,
                     xor(list_reduce(list_transform(range(1, len(conv_id::varchar) + 1), lambda i: ascii(substr(conv_id::varchar, i::int, 1))::bigint),
                         lambda crc, b: list_reduce(range(8), lambda x, i: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end, xor(crc, b)),
                         4294967295::bigint), 4294967295) % 6 as h
              from turn group by conv_id),
     seq as materialized (select c.conv_id, coalesce(b.s[1 : c.h], []) || coalesce(c.s[c.h + 1 :], []) as s
             from conv c left join conv b on b.conv_id = c.head),
     node as materialized (
       select p, len(p) as depth, min(conv_id) as conv_id, count(*) as n_convs,
              coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (len(s) = len(p)), '') as ends
       from (select conv_id, s, s[1 : d] as p from (select conv_id, s, unnest(range(len(s) + 1)) as d from seq)) group by p),
     full_node as materialized (
       select n.*, u.conv_id as parent_conv_id, (select count(*) from node k where k.depth = n.depth + 1 and k.p[1 : n.depth] = n.p) as n_children
       from node n left join node u on n.depth > 0 and u.p = n.p[1 : n.depth - 1])
select a.conv_id, a.depth, a.parent_conv_id, a.n_convs, a.n_children,
       count(*) filter (b.n_children = 0) as n_leaves,
       sum(case when b.depth = 0 then 0 else (b.n_convs - 1) * len(b.p[b.depth].t) end)::bigint as saved_tokens, sha256(a.ends) as ends_sha256
from full_node a join full_node b on b.depth >= a.depth and b.p[1 : a.depth] = a.p
group by a.conv_id, a.depth, a.parent_conv_id, a.n_convs, a.n_children, a.ends, a.p
""")
def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """All nodes of the prefix trie of the conversations, rebuilt on the first turns of their family's head."""
    digests = materialize(prefix_trie.digest_turns(read_table(spark, folder, "conversations")), "turn-digests")
    return prefix_trie.trie_of(*prefix_trie.splice_families(digests))
