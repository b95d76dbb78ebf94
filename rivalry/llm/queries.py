"""The registered corpus queries: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivalry.llm import (
    align,
    chat,
    decontaminate,
    pages,
    pieces,
    pii,
    quality,
    repeats,
    rules,
    shards,
    similar,
    topk,
    variants,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = quality.fit(documents, table(spark, sf_dir, "labels"))
    return quality.select(quality.rate(documents.select("doc_id", "text"), model)).drop("text")


SHARDS = [f"shard-{i:02d}" for i in range(64)]
SLOTS = 6_421


def op1_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The (document, item) pairs that overlap, one row each."""
    return decontaminate.overlaps(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render(table(spark, sf_dir, "conversations"))


OP2_SQL = """
with turns as (
    select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
        row_number() over (partition by conv_id order by turn, role, text) as place
    from conversations
), whole as (
    select conv_id, count(*) as n_turns,
        list(struct_pack(role := role, text := text) order by place) as said,
        string_agg('<|im_start|>' || replace(role, '<|', '< |') || chr(10)
            || replace(text, '<|', '< |') || '<|im_end|>' || chr(10), '' order by place) as text
    from turns group by conv_id
), reps as (
    select min(conv_id) as conv_id, n_turns, said, text, count(*) as n_copies
    from whole group by n_turns, said, text
), begun as (
    select distinct said[1:k] as said
    from (select said, unnest(range(1, n_turns)) as k from reps)
)
select conv_id, n_turns, n_copies, text
from reps anti join begun using (said)
"""


def op4_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id")
    return shards.place(documents, "doc_id", SHARDS, SLOTS)


OP4_SQL = f"""
with recursive names as (
    select i, printf('shard-%02d', i) as name from range({len(SHARDS)}) t(i)
), orders as (
    select i, ('0x' || left(md5(name || '/start'), 15))::bigint % {SLOTS} as start,
        ('0x' || left(md5(name || '/width'), 15))::bigint % {SLOTS - 1} + 1 as width
    from names
), claims as (
    select 0 as turn, list_transform(range({SLOTS}), lambda s: -1) as owner
    union all
    select turn + 1, owner[:chosen] || [i] || owner[chosen + 2:]
    from (
        select turn, owner, i, list_filter(
            list_transform(range({SLOTS}), lambda k: (start + k * width) % {SLOTS}),
            lambda s: owner[s + 1] = -1)[1] as chosen
        from claims join orders on i = turn % {len(SHARDS)}
        where turn < {SLOTS}
    )
), owners as (
    select unnest(range({SLOTS})) as slot, unnest(owner) as shard
    from claims where turn = {SLOTS}
), placed as (
    select doc_id, ('0x' || left(md5(coalesce(doc_id::varchar, '')), 15))::bigint % {SLOTS} as slot
    from documents
)
select doc_id, slot::int as slot, shard::int as shard from placed join owners using (slot)
"""


def op5_similar(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = similar.near_duplicates(table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("_id", "doc_id")


def op6_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


_PART = 0.05 / len(rules.RULES)
_TESTS = [(rule, i, cutoff) for rule in rules.RULES for i, cutoff in enumerate(rule.cutoffs)]
_TALLIES = ",\n".join(
    f"count(*) filter (lowest > 0 and {rule.value} > {cutoff}) as {rule.name}_{i},"
    f" count(*) filter (lowest <= 0 and {rule.value} > {cutoff}) as {rule.name}_{i}_bad"
    for rule, i, cutoff in _TESTS
)
_STRUCTS = ", ".join(
    f"{{'rule': '{rule.name}', 'cutoff': {cutoff}::double, 'k': {rule.name}_{i},"
    f" 'k_bad': {rule.name}_{i}_bad}}"
    for rule, i, cutoff in _TESTS
)
_BREACHES = ", ".join(
    f"case when {rule.value} > (select cutoff from chosen c"
    f" where c.stratum = j.stratum and c.rule = '{rule.name}') then '{rule.name}' end"
    for rule in rules.RULES
)
OP6_SQL = f"""
with split as (
    select row_number() over () as r, doc_id, coalesce(lang, '') as stratum,
        coalesce(text, '') as t,
        regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w,
        list_filter(string_split(coalesce(text, ''), chr(10)),
            lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as lines
    from documents
), windows as (
    select r, i, w[i:i + 7] as win from split, unnest(range(1, len(w) - 6)) u(i)
), twice as (
    select r, unnest(list(i)) as i from windows group by r, win having count(*) > 1
), covered as (
    select r, count(distinct i + k) as n from twice, range(8) t(k) group by r
), counted as (
    select doc_id, stratum, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
        length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols,
        len(lines) - len(list_distinct(lines)) as n_dup_lines,
        coalesce(n, 0) as n_repeat_words, len(lines) as n_lines,
        length(t) - length(replace(t, '!', '')) as n_shouts
    from split left join covered using (r)
), judged as (
    select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from counted
), lowest as (
    select doc_id, min(quality) as lowest from labels
    where quality is not null and doc_id is not null group by doc_id
), tallied as (
    select stratum, count(*) filter (lowest > 0) as n, count(*) filter (lowest <= 0) as n_bad,
        {_TALLIES}
    from judged join lowest using (doc_id) where not base_failed
    group by stratum having count(*) filter (lowest > 0) > 0
), tests as (
    select stratum, n, n_bad, (select count(*) from tallied) as n_strata,
        unnest([{_STRUCTS}], recursive := true)
    from tallied
), proven as (
    select *, k_bad / greatest(n_bad, 1) - 10 * k / n as gain from tests
    where k < {_PART!r} * n and list_sum(list_transform(range(0, k + 1), lambda i: exp(
        lgamma(n + 1.0) - lgamma(i + 1.0) - lgamma(n - i + 1.0)
        + i * ln({_PART!r}) + (n - i) * ln(1 - {_PART!r}))))
        <= 0.05 / (n_strata * {len(rules.RULES)})
), chosen as (
    select stratum, rule, arg_max(cutoff, {{'gain': gain, 'cutoff': cutoff}}) as cutoff
    from proven where gain > 0 group by stratum, rule
), breached as (
    select *, list_filter([{_BREACHES}], lambda x: x is not null) as breaches from judged j
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    not base_failed and len(breaches) = 0 as kept, array_to_string(breaches, ',') as breaches
from breached
"""


#: Of a deployment's own secret store; surrogates can't be told without it.
KEY = "change-me"


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, text, n_entities: every document with surrogates for personal data."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.replace(documents, KEY)


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0), lambda n, s: n + s["stop"] - s["start"])
    return left.select(
        "doc_id",
        "n_words",
        removed.cast("long").alias("n_removed"),
        F.sha2("kept_text", 256).alias("kept_sha256"),
        F.size("spans").cast("long").alias("n_spans"),
    )


OP8_SQL = """
with split as (
    select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w
    from documents
), windows as (
    select doc_id, i, w[i:i + 19] as win from split, unnest(range(1, len(w) - 18)) u(i)
), firsts as (
    select win, min({'doc_id': doc_id, 'i': i}) as f
    from windows group by win having count(*) > 1
), later as (
    select doc_id, i from windows join firsts using (win)
    where f <> {'doc_id': doc_id, 'i': i}
), gone as (
    select doc_id, list_sort(list_distinct(list(i + k))) as words
    from later, range(20) t(k) group by doc_id
), cut as (
    select split.doc_id, w, coalesce(words, []) as words,
        list_filter(w, lambda x, i: not list_contains(coalesce(words, []), i)) as kept
    from split left join gone on gone.doc_id = split.doc_id
)
select doc_id, len(w) as n_words, len(words) as n_removed,
    sha256(array_to_string(kept, ' ')) as kept_sha256,
    len(list_filter(words, lambda x, i: i = 1 or words[i - 1] <> x - 1)) as n_spans
from cut
"""


def op9_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = pages.extract(table(spark, sf_dir, "pages"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))


#: The given pages hold one article element each, of headings and paragraphs.
OP9_SQL = """
with articles as (
    select page_id, url,
        regexp_extract(coalesce(html, ''), '<article>(.*?)</article>', 1, 's') as article
    from pages
), parts as (
    select page_id, url, list_transform(
        string_split(regexp_replace(article, '</?(p|h1)>', chr(1), 'g'), chr(1)),
        lambda x: trim(regexp_replace(replace(replace(replace(replace(
            regexp_replace(regexp_replace(x, '<br>', ' ', 'g'), '<[^>]*>', '', 'g'),
            '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', chr(39)), '\\s+', ' ', 'g'))
        ) as blocks
    from articles
), texts as (
    select page_id, url, regexp_replace(array_to_string(
        list_filter(blocks, lambda x: x <> ''), chr(10)), '&amp;?', '&', 'g') as text
    from parts
)
select page_id, url, text, length(text) as n_chars from texts
"""


#: A public model that merges pairs; any other SentencePiece model file will do.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def op10_pieces(spark: SparkSession, sf_dir: str, model: str = MODEL) -> DataFrame:
    """doc_id, ids, n_ids, exact: the ids of every document, decoded again and compared."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.encode(documents, pieces.Vocabulary.load(model)).drop("text")


def op11_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group(table(spark, sf_dir, "documents"))


#: crc32 by its table of 256 remainders, then near words by their texts without one code point.
OP11_SQL = """
with recursive remainders as (
    select list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k:
        case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i)) as tab
), runs as (
    select doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run
    from (select doc_id, unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')) as run
        from documents)
), counted as (
    select coalesce(doc_id::varchar, '') || ':' || run as key, run, count(*) as n
    from runs group by all
), hashed as (
    select run, n, xor(4294967295, list_reduce(
        list_transform(range(octet_length(encode(key))),
            lambda i: ('0x' || substr(hex(encode(key)), 2 * i + 1, 2))::bigint),
        lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]), 4294967295)) as h
    from counted, remainders
), words as (
    select word, sum(n)::bigint as n from (
        select n, case when h % 31 <> 0 then run
            else run[:h % length(run)] || run[h % length(run) + 2:] end as word
        from hashed)
    where length(word) >= 7 group by word having sum(n) >= 2
), less as (
    select word, i, word[:i] || word[i + 2:] as rest
    from words, unnest(range(length(word))) t(i)
), near as (
    select a.word, b.word as other from less a join less b using (rest, i) where a.word <> b.word
    union select l.word, w.word from less l join words w on l.rest = w.word
    union select w.word, l.word from less l join words w on l.rest = w.word
), best as (
    select word, count(*) as n_near, min({'n': -n, 'word': other}) as b
    from near join (select word as other, n from words) using (other) group by word
), formed as (
    select word, case when -b.n >= 10 * n then b.word end as form, n,
        coalesce(n_near, 0) as n_near, case when -b.n >= 10 * n then -b.n end as form_n
    from words left join best using (word)
), chains as (
    select word, word as root, 0 as step from formed
    union all
    select c.word, f.form, step + 1 from chains c join formed f on f.word = c.root
    where f.form is not null
)
select word, form, (select arg_max(root, step) from chains c where c.word = f.word) as root,
    n, n_near, form_n::bigint as form_n
from formed f
"""


def op12_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """query_id, rank, vec_id, score: of every 50th vector the five best others."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


OP12_SQL = """
with rows as (
    select row_number() over () as r, vec_id,
        list_transform(embedding, lambda x: floor(256 * x::double)::double) as v
    from embeddings
    where embedding is not null
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
    select q.r, q.vec_id as query_id, c.vec_id, list_dot_product(q.v, c.v)::bigint as score
    from rows q join rows c on q.vec_id % 50 = 0 and q.r <> c.r
), ranked as (
    select *, row_number() over (
        partition by r order by score desc, vec_id asc nulls last) as rank
    from scored
)
select query_id, rank::int as rank, vec_id, score from ranked where rank <= 5
"""


#: A public byte-level vocabulary.
BYTES = "/opt/tokenizers/byte_bpe_50k.json"


def op13_align(spark: SparkSession, sf_dir: str, one: str = BYTES, two: str = MODEL) -> DataFrame:
    return align.align(table(spark, sf_dir, "documents"), align.Pair.load(one, two))


QUERIES = {
    "op1_overlaps": op1_overlaps,
    "op2_chat": op2_chat,
    "op3_quality": op3_quality,
    "op4_shards": op4_shards,
    "op5_similar": op5_similar,
    "op6_rules": op6_rules,
    "op7_pii": op7_pii,
    "op8_repeats": op8_repeats,
    "op9_pages": op9_pages,
    "op10_pieces": op10_pieces,
    "op11_variants": op11_variants,
    "op12_topk": op12_topk,
    "op13_align": op13_align,
}

ORACLE = {
    "op2_chat": OP2_SQL,
    "op4_shards": OP4_SQL,
    "op6_rules": OP6_SQL,
    "op8_repeats": OP8_SQL,
    "op9_pages": OP9_SQL,
    "op11_variants": OP11_SQL,
    "op12_topk": OP12_SQL,
}
