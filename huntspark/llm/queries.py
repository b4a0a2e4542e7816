"""The dealt operators as queries over whole tables, with SQL where SQL can express them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from huntspark.llm.chat import perspectives
from huntspark.llm.common import table
from huntspark.llm.embeddings import near_vectors
from huntspark.llm.hard_negatives import mine_negatives
from huntspark.llm.leaks import find_leaks
from huntspark.llm.line_dedup import deduplicated
from huntspark.llm.manifest import manifest
from huntspark.llm.mixing import taken_words
from huntspark.llm.simhash import near_copies
from huntspark.llm.style_tree import main_text
from huntspark.llm.token_counts import piece_scores, token_counts
from huntspark.llm.token_shards import read_documents, write_shards
from huntspark.llm.toxicity import fit, judged
from huntspark.llm.url_rules import filter_urls, label_urls, mine_block_rules
from huntspark.plans.lineage_cut import shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
BYTE_BPE, BYTE_BPE_IDS = "byte_bpe_50k.json", 50257
PIECES = "piece_bpe_32k.model"


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def written_documents(docs: DataFrame) -> DataFrame:
    """The documents of shard files made of ``docs``, read back from the shared folder."""
    path = f"{shared_folder(docs.sparkSession)}/shards-{uuid.uuid4().hex}"
    write_shards(docs, path, public_tokenizers.path(BYTE_BPE))
    return read_documents(docs.sparkSession, path, BYTE_BPE_IDS)


@query()
def op1_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = written_documents(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "start", "n_tokens", "ids_crc32")


@query()
def op2_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken_words(table(spark, sf_dir, "documents"))


@query()
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts(docs, piece_scores(public_tokenizers.path(PIECES)))
    return counted.select("doc_id", "n_words", "n_tokens")


@query()
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_copies(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query(
    """
    with line as (
      select conv_id, coalesce(cast(floor(turn / 256) as bigint), -1) as part, coalesce(turn, -4611686018427387904) as turn,
             coalesce(role, 'unknown') as role, coalesce(text, '') as text
      from conversations),
    speaker as (select distinct conv_id, role as speaker from conversations where role is not null and role <> 'system'),
    shown as (
      select l.*, s.speaker, l.role = s.speaker as own,
             case when l.role = s.speaker then '<|assistant|>' || chr(10)
                  when l.role = 'system' then '<|system|>' || chr(10)
                  else '<|user name=' || l.role || '|>' || chr(10) end as head,
             l.text || '<|end|>' as body
      from line l join speaker s on l.conv_id is not distinct from s.conv_id),
    placed as (
      select *, coalesce(sum(length(head) + length(body) + 1) over (
               partition by conv_id, speaker, part order by turn, role, text
               rows between unbounded preceding and 1 preceding), 0) as pos
      from shown)
    select conv_id, speaker, part, string_agg(head || body || chr(10), '' order by turn, role, text) as text,
           coalesce(string_agg(case when own then (pos + length(head)) || '-' || (pos + length(head) + length(body)) end, ','
             order by pos), '') as spans,
           cast(count(*) as integer) as n_turns,
           cast(sum(length(head) + length(body) + 1) - sum(case when own then length(body) else 0 end) as integer) as n_masked
    from placed group by conv_id, speaker, part
    """
)
def op5_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = perspectives(table(spark, sf_dir, "conversations"))
    spans = F.transform("spans", lambda x: F.concat(x["start"].cast("string"), F.lit("-"), x["end"].cast("string")))
    return found.withColumn("spans", F.array_join(spans, ","))


@query()
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return judged(docs, fit(docs, table(spark, sf_dir, "labels")))


@query()
def op7_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op8_embedding_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


@query()
def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


@query(
    r"""
    with parts as (
      select page_id, url,
        case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest,
        coalesce(regexp_extract(url, '\?([^#]*)', 1), '') as query
      from pages),
    page as (
      select page_id, url, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path, query
      from parts),
    told as (
      select *, list_sort(list_distinct(list_filter(list_concat(['d:' || host],
          [ 'h:' || t for t in string_split_regex(regexp_replace(host, '[0-9]+', '#', 'g'), '[^a-z0-9]+') ],
          [ 'p:' || t for t in string_split_regex(regexp_replace(path, '[0-9]+', '#', 'g'), '[/._-]+') ],
          [ 'q:' || t for t in string_split(regexp_replace(query, '[0-9]+', '#', 'g'), '&') ]), lambda t: length(t) > 2))) as tokens
      from page),
    labelled as (
      select row_number() over () as n, t.tokens, coalesce(l.quality = 0, false) or coalesce(l.toxic = 1, false) as blocked
      from told t join labels l on l.doc_id = try_cast(nullif(regexp_extract(t.url, '/([0-9]+)', 1), '') as bigint)
      where l.quality is not null or l.toxic is not null),
    mask as (select tokens, unnest(range(1, cast(pow(2, len(tokens)) as bigint))) as m from labelled where blocked),
    subset as (
      select list_sort([t for t, k in tokens if (m >> (k - 1)) & 1 = 1]) as a from mask),
    often as (select a, count(*) as hits from subset group by a having count(*) >= 5),
    rated as (
      select a, hits, count(*) as n, hits / count(*) as p from often join labelled on list_has_all(tokens, a) group by a, hits),
    rule as (
      select a from (select a, (p + 6.635776 / (2 * n) - 2.576 * sqrt(p * (1 - p) / n + 6.635776 / (4 * n * n))) / (1 + 6.635776 / n) as low from rated)
      where low >= 0.5 and low > (select avg(cast(blocked as integer)) from labelled)),
    blocked as (select distinct t.page_id, t.url from told t join rule r on list_has_all(t.tokens, r.a)),
    explicit(verdict, h, p) as (
      values ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'),
             ('block', 'net', '/fr/')),
    best as (
      select t.page_id, t.url, arg_max(e.h || e.p, length(e.h || e.p)) as rule, arg_max(e.verdict, length(e.h || e.p)) as verdict
      from (select distinct page_id, url, host, path from told) t
      join explicit e on (t.host = e.h or ends_with(t.host, '.' || e.h)) and starts_with(t.path, e.p)
      group by t.page_id, t.url)
    select t.page_id, t.host, t.path, e.rule, coalesce(e.verdict, case when b.page_id is not null then 'block' else 'allow' end) as verdict
    from told t
    left join best e on t.page_id is not distinct from e.page_id and t.url is not distinct from e.url
    left join blocked b on t.page_id is not distinct from b.page_id and t.url is not distinct from b.url
    """
)
def op10_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    mined = mine_block_rules(label_urls(pages, table(spark, sf_dir, "labels")))
    return filter_urls(pages, mined)


@query(
    """
    with usable as (
      select vec_id, case when vec_id % 7 = 0 then (cast(label as bigint) + 1) % 10 else label end as label,
             list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as whole
      from embeddings
      where vec_id is not null and label is not null and embedding is not null
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    scored as (
      select a.vec_id as anchor_id, r.vec_id, r.label = a.label as same,
             cast(coalesce(list_sum(list_transform(list_zip(a.whole, r.whole), lambda z: z[1] * z[2])), 0) as bigint) as score
      from usable a join usable r on a.vec_id % 100 = 0 and a.vec_id <> r.vec_id and len(a.whole) = len(r.whole)),
    positive as (
      select anchor_id, vec_id as positive_id, score as positive_score from scored where same
      qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5),
    inside as (
      select anchor_id, positive_id, vec_id as negative_id, positive_score, score as negative_score,
             cast(row_number() over (partition by anchor_id, positive_id order by score desc, vec_id) as integer) as rank
      from positive join scored using (anchor_id)
      where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score)
    select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from inside where rank <= 10
    """
)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_negatives(table(spark, sf_dir, "embeddings"))


@query(
    r"""
    with recursive
    told as (
      select doc_id, source, coalesce(strlen(cast(doc_id as varchar)) || ':' || doc_id, '-')
               || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
               || coalesce(strlen(cast(n_chars as varchar)) || ':' || n_chars, '-') as head,
             text, replace(text, chr(10), '') as flat,
             list_reduce(
               [cast(4294967295 as bigint)] || list_transform(string_split(cast(doc_id as varchar), ''), lambda c: cast(ascii(c) as bigint)),
               lambda crc, byte: list_reduce([xor(crc, byte)] || range(8),
                 lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))) as crc
      from documents),
    leaf as (
      select doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) as leaf,
             sha256(head || coalesce(strlen(flat) || ':' || flat, '-')) as altered, xor(crc, 4294967295) % 2 = 0 as touched
      from told),
    place as (
      select *, dense_rank() over (order by source nulls first) - 1 as tree,
             row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as spot
      from leaf),
    node(tree, level, spot, h, n) as (
      select tree, 0, spot, leaf, count(*) over (partition by tree) from place
      union all
      select distinct tree, level + 1, spot // 3, sha256(string_agg(h, '' order by spot) over (partition by tree, spot // 3)), (n + 2) // 3
      from node where n > 1),
    top as (select tree as spot, h from node where n = 1),
    upper(level, spot, h, n) as (
      select 0, spot, h, count(*) over () from top
      union all
      select distinct level + 1, spot // 3, sha256(string_agg(h, '' order by spot) over (partition by spot // 3)), (n + 2) // 3
      from upper where n > 1),
    step as (
      select tree, level, spot, h, n from node
      union all select -1, level, spot, h, n from upper),
    run as (
      select tree, level, spot // 3 as above, list({'spot': spot, 'h': h} order by spot) as members from step where n > 1 group by all),
    path(tree, spot, home, level, pos, within, proof, folded) as (
      select tree, spot, tree, 0, spot, tree, '', case when touched then altered else leaf end from place
      union all
      select p.tree, p.spot, p.home, case when r.tree is null then 0 else p.level + 1 end,
             case when r.tree is null then p.home else p.pos // 3 end,
             case when r.tree is null then -1 else p.within end,
             p.proof || coalesce(list_aggregate(list_transform(list_filter(r.members, lambda m: m.spot <> p.pos), lambda m: m.h), 'string_agg', ''), ''),
             case when r.tree is null then p.folded
                  else sha256(list_aggregate(list_transform(r.members, lambda m: case when m.spot = p.pos then p.folded else m.h end), 'string_agg', '')) end
      from path p left join run r on r.tree = p.within and r.level = p.level and r.above = p.pos // 3
      where r.tree is not null or p.within <> -1),
    proof as (
      select tree, spot, proof, folded from path
      where within = -1 and not exists (select 1 from run r where r.tree = -1 and r.level = path.level and r.above = path.pos // 3))
    select p.doc_id, p.leaf, t.h as subroot, u.h as root, sha256(f.proof) as proof_sha256, f.folded as folded_root, f.folded = u.h as verified
    from place p join proof f using (tree, spot) join top t on t.spot = p.tree join (select h from upper where n = 1) u on true
    """
)
def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"))


@query(
    """
    with line as (
      select row_number() over () as row, doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents),
    flat as (
      select row, doc_id, unnest(lines) as line, generate_subscripts(lines, 1) as place from line),
    keyed as (
      select *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
      from flat),
    shared as (
      select key, min(doc_id) as least from keyed where length(key) >= 10 group by key
      having count(distinct doc_id) + max(case when doc_id is null then 1 else 0 end) >= 2),
    judged as (
      select k.*, s.key is not null and k.doc_id is distinct from s.least as dropped from keyed k left join shared s using (key))
    select any_value(doc_id) as doc_id, count(*) as n_lines, cast(count(*) filter (where dropped) as bigint) as n_dropped,
           sha256(coalesce(string_agg(line, chr(10) order by place) filter (where not dropped), '')) as kept_sha256
    from judged group by row
    """
)
def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return deduplicated(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))
