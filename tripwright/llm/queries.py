"""The dealt operators as queries over whole tables: ``QUERIES[name](spark, folder)``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwright.llm import filter_audit, katz, line_chunks, mixing, neighbours, ngram_jaccard, phrases, quality, sentencepiece, threshold_topk, token_files, toxicity, warc

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
#: SQL for another engine, where it can express the query.
ORACLE: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _remainder(n: int):
    """crc32 of the id as text, modulo n."""
    return F.crc32(F.col("doc_id").cast("string")) % n


def _public(name: str) -> str:
    """Path of a public tokenizer's file; their folder is a parameter of the installation."""
    import public_tokenizers

    return public_tokenizers.path(name)


def public_file(name: str) -> bytes:
    with open(_public(name), "rb") as file:
        return file.read()


@query
def op1_sentencepiece(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    encoded = sentencepiece.encode(docs, public_file("piece_bpe_32k.model"))
    return encoded.select("doc_id", F.size("ids").alias("n_pieces"), "ids", "round_trip")


@query
def op2_ngram_jaccard(spark, folder):
    return ngram_jaccard.join(table(spark, folder, "documents"), size=3, num=90, den=100)


ORACLE["op2_ngram_jaccard"] = r"""
with recursive t as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
s as (
  select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
         else list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) end) as g
  from t),
n as (select doc_id, count(*) as n from s group by 1),
o as (select a.doc_id as x, b.doc_id as y, count(*) as shared
      from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2),
links as (select x, y from o join n a on a.doc_id = x join n b on b.doc_id = y
          where 100 * shared >= 90 * (a.n + b.n - shared)),
reach as (select doc_id as x, doc_id as y from documents
          union select r.x, l.y from reach r join links l on l.x = r.y)
select d.doc_id, coalesce(n.n, 0) as n_shingles,
       (select min(y) from reach r where r.x = d.doc_id) as component_id,
       (select count(*) from links l where l.x = d.doc_id) as n_links
from documents d left join n using (doc_id)"""


@query
def op3_token_files(spark, folder):
    written = token_files.write(table(spark, folder, "documents"), _public("byte_bpe_50k.json"))
    return token_files.digest(spark, written)


@query
def op5_katz_scores(spark, folder):
    docs = table(spark, folder, "documents")
    scored = katz.score(katz.fit(docs, _remainder(7) != 2))
    return scored.select(
        "doc_id", F.coalesce(_remainder(7) == 2, F.lit(False)).alias("held_out"),
        "n_tokens", "n_known", "train_tokens", "base_score", "score",
    )


def language_labels(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Domains of the labelled documents: their languages."""
    known = docs.select("doc_id", F.col("lang").alias("domain"))
    return known.join(labels.select("doc_id").distinct(), "doc_id", "left_semi")


def source_labels(docs: DataFrame) -> DataFrame:
    """Domains of the documents that name their source."""
    return docs.select("doc_id", F.col("source").alias("domain"))


def quality_labels(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Domains of the labelled documents: language and quality. Languages beyond the 31 most labelled are one."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang")
    marked = labels.where("quality is not null").select("doc_id", (F.col("quality") == 1).alias("good")).distinct()
    known = docs.select("doc_id", lang).join(marked, "doc_id")
    most = [r["lang"] for r in known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(31).collect()]
    named = F.when(F.col("lang").isin(most), F.col("lang")).otherwise(F.lit("other"))
    return known.select("doc_id", F.concat(named, F.when(F.col("good"), "/good").otherwise("/poor")).alias("domain"))


def quality_targets(held: dict[str, float]) -> dict[str, float]:
    """Languages weigh their tokens to the power 0.7; within each, good and poor texts keep their shares."""
    languages: dict[str, float] = {}
    for domain, tokens in held.items():
        language = domain.rpartition("/")[0]
        languages[language] = languages.get(language, 0.0) + tokens
    return {d: x * languages[d.rpartition("/")[0]] ** (mixing.TEMPERATURE - 1) for d, x in held.items() if x > 0}


def mixture_of(docs: DataFrame, labels: DataFrame, grow: bool = False) -> mixing.Mixture:
    """Every text's language and quality come from the classifier; its source, which texts do not tell, is a group."""
    return mixing.mix(docs, quality_labels(docs, labels), quality_targets, grow, groups="source")


@query
def op4_mixing(spark, folder):
    mixture = mixture_of(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return mixture.rows.select("doc_id", "n_tokens", F.col("p").alias("posterior"), "rate", "copies")


@query
def op6_warc(spark, folder):
    pages = table(spark, folder, "pages")
    archives = warc.write(pages)
    index = warc.index(warc.records(spark, archives))
    return warc.captured(spark, archives, index, pages.select("url")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


ORACLE["op6_warc"] = """
with p as (select page_id, coalesce(html, '') as payload from pages),
q as (select page_id, strlen(payload) as payload_bytes, sha1(payload) as payload_digest,
             max(page_id) over (partition by payload) as newest from p)
select page_id, payload_bytes, payload_digest,
       case when payload_bytes >= 1000 and page_id <> newest then 'revisit' else 'response' end as record_type,
       case when payload_bytes >= 1000 and page_id <> newest then newest end as refers_to
from q"""


@query
def op7_line_chunks(spark, folder):
    return line_chunks.remove(table(spark, folder, "documents").select("doc_id", "text"), whole=True)


@query
def op8_quality_rules(spark, folder):
    judged = quality.judge(table(spark, folder, "documents"))
    failed = F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words")
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & F.col("good")).alias("kept"), "posterior",
    )


def _toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    learnt = labels.where(_remainder(5) != 0)
    model = toxicity.fit(toxicity.labelled(docs, learnt))
    return toxicity.score(docs, model)


@query
def op9_toxicity(spark, folder):
    scored = _toxicity_scores(table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "labels"))
    return scored.select(
        "doc_id", (_remainder(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query
def op10_neighbours(spark, folder):
    return neighbours.search(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


@query
def op11_phrases(spark, folder):
    return phrases.mine(table(spark, folder, "documents"))


ORACLE["op11_phrases"] = r"""
with t as (select row_number() over () as id, coalesce(lang, 'und') as lang, translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as x from documents),
p as (select lang, unnest(regexp_split_to_array(x, '[.,;:!?\x0A-\x0D]')) as x from t),
w as (select lang, regexp_extract_all(x, '[^\x20\x09]+') as w from p),
g as (select lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) as g
      from w, (select unnest([1, 2, 3, 4, 5]) as k) where len(w) >= k),
f as (select lang, k, g, count(*) as f from g group by 1, 2, 3),
t1 as (select lang, sum(f) as n from f where k = 1 group by 1),
c as (select lang, k, g, f as a, string_split(g, ' ') as w from f where k > 1 and f >= 100),
cuts as (select c.*, j, array_to_string(w[1:j], ' ') as x, array_to_string(w[j + 1:], ' ') as y
         from c, (select unnest([1, 2, 3, 4]) as j) where j < k),
s as (select u.lang, u.k, u.g, u.a, u.j, l.f as l, r.f as r, t1.n,
        (1000 * u.a::hugeint * t1.n::hugeint) // (l.f::hugeint * r.f::hugeint) as score
      from cuts u join f l on l.lang = u.lang and l.g = u.x join f r on r.lang = u.lang and r.g = u.y
      join t1 on t1.lang = u.lang),
b as (select *, row_number() over (partition by lang, g order by score, j) as nth from s),
inside as (select distinct s.lang, s.g from c s join c b on s.lang = b.lang and s.k < b.k
           and 100 * b.a >= 100 * s.a and contains(' ' || b.g || ' ', ' ' || s.g || ' ')),
o as (select b.* from b anti join inside using (lang, g) where nth = 1),
z as (select *, row_number() over (partition by lang order by score desc, a desc, encode(g)) as rank from o)
select lang, rank::bigint as rank, g as phrase, a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n,
  score::bigint as score from z where rank <= 2000"""


@query
def op12_threshold_topk(spark, folder):
    return threshold_topk.search(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


ORACLE["op12_threshold_topk"] = """
with v as (select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)) as x from embeddings
           where vec_id is not null and embedding is not null
             and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id as query_id, c.vec_id, list_dot_product(q.x, c.x)::bigint as score
      from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 100 = 0),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, rank::int as rank, vec_id, score from r where rank <= 10"""


@query
def op13_filter_audit(spark, folder):
    return filter_audit.audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


ORACLE["op13_filter_audit"] = r"""
with t as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as x from documents),
w as (select *, regexp_extract_all(x, '[^\x20\x09-\x0D]+') as w, min(doc_id) over (partition by x) as first from t),
l as (select doc_id, max((coalesce(quality, 0) = 1)::int) as good, max((coalesce(toxic, 0) = 1)::int) as toxic
      from labels group by 1),
m as (select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
        concat(case when len(w) < 200 then 'A' else '' end,
          case when 100 * len(list_distinct(w)) < 50 * len(w) then 'B' else '' end,
          case when 100 * length(regexp_replace(x, '[^A-Z]', '', 'g')) > 3 * length(x) then 'C' else '' end,
          case when regexp_matches(x, '[#$%&*|]') then 'D' else '' end,
          case when first < doc_id then 'E' else '' end) as fails
      from w left join l using (doc_id)),
c as (select part, fails, count(*) as n, sum(good) as good, sum(toxic) as toxic from m group by 1, 2),
f as (select unnest(['A', 'B', 'C', 'D', 'E']) as f),
o as (select a.f || b.f || c.f || d.f || e.f as o from f a, f b, f c, f d, f e
      where a.f not in (b.f, c.f, d.f, e.f) and b.f not in (c.f, d.f, e.f) and c.f not in (d.f, e.f) and d.f <> e.f),
s as (select o, step, substr(o, step, 1) as f, substr(o, 1, step - 1) as earlier
      from o, (select unnest([1, 2, 3, 4, 5]) as step)),
r as (select c.part, o as filter_order, step, f,
        sum(case when translate(fails, earlier || f, '') = fails then n else 0 end) as kept,
        sum(case when contains(fails, f) and translate(fails, earlier, '') = fails then n else 0 end) as removed,
        sum(case when contains(fails, f) and translate(fails, earlier, '') <> fails then n else 0 end) as redundant,
        sum(case when fails = f then n else 0 end) as unique_fails,
        sum(case when contains(fails, f) and translate(fails, earlier, '') = fails then good else 0 end) as good_lost,
        sum(case when contains(fails, f) and translate(fails, earlier, '') = fails then toxic else 0 end) as toxic_lost
      from c, s group by 1, 2, 3, 4)
select part, filter_order, step, kept::bigint as kept, removed::bigint as removed, redundant::bigint as redundant,
  unique_fails::bigint as unique_fails, good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost,
  (sum(removed) over (partition by part, f))::bigint as shapley
from r"""
