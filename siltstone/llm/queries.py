"""The registered query of every operator, with its SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import credentials, decontamination, digests, fingerprints, langid, language_model, manifest, packing, simhash, spelling, substrings, toxicity, urls
from siltstone.llm.registry import ORACLES, QUERIES, query, table

__all__ = ["ORACLES", "QUERIES"]

#: Host, path, verdict.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def vocabulary(name: str) -> str:
    """Where the installed public tokenizers keep a vocabulary file."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


@query("op1_substring_dedup")
def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = substrings.without_repeats(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query(
    "op2_url_filters",
    r"""
    with parts as (
        select page_id,
            translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
            coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') as path
        from pages),
    rules(h, p, v) as (values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
        ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
    fits as (
        select distinct host, path, first_value(h || p) over w as rule, first_value(v) over w as verdict
        from (select distinct host, path from parts)
        join rules on (host = h or ends_with(host, '.' || h)) and starts_with(path, p)
        window w as (partition by host, path order by length(h || p) desc))
    select page_id, parts.host, parts.path, rule, coalesce(verdict, 'allow') as verdict
    from parts left join fits on parts.host = fits.host and parts.path = fits.path
    """,
)
def op2_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    entries = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = table(spark, folder, "pages").select("page_id", "url")
    return urls.listed(pages, entries).select("page_id", "host", "path", "rule", "verdict")


@query("op3_toxicity")
def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op4_decontamination")
def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op5_simhash")
def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


@query("op6_document_fingerprints")
def op6_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.document_fingerprints(table(spark, folder, "documents"))


@query("op7_secret_scans")
def op7_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    found = credentials.secret_spans(table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        *[credentials.counted("base", kind).alias(f"n_{kind}") for kind in credentials.BASE],
        F.sha2(credentials.spelled("base"), 256).alias("base_sha256"),
        credentials.spelled("spans").alias("spans"),
    )


@query("op8_lm_scoring")
def op8_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return language_model.scores(docs, language_model.train(language_model.training_rows(docs)))


@query("op9_packing")
def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(table(spark, folder, "documents"), vocabulary("byte_bpe_50k.json"))


@query("op10_language_id")
def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return langid.languages(docs, langid.train(docs))


@query(
    "op11_exact_dedup",
    r"""
    with texts as (select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256 from documents),
    groups as (select text_sha256, min(doc_id) as keep_id, count(*) as group_size from texts group by text_sha256)
    select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256 from texts join groups using (text_sha256)
    """,
)
def op11_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return digests.new_index(spark).add(table(spark, folder, "documents"), "documents")


#: crc32 in SQL: the table of its 256 steps, and the fold over the bytes of a list.
SQL_CRC_TABLE = "select list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i)) as steps"
SQL_CRC = "xor(list_reduce({bytes}, lambda c, b: xor(steps[(xor(c, b) & 255) + 1], c >> 8), 4294967295), 4294967295)"
SQL_BYTES = "flatten(list_transform(string_split({text}, ''), lambda x: case when ord(x) < 128 then [ord(x)::bigint] else [192 + (ord(x) >> 6), 128 + (ord(x) & 63)]::bigint[] end))"


@query(
    "op12_spelling_variants",
    rf"""
    with recursive crc_table as ({SQL_CRC_TABLE}),
    found as (select doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) as raw from documents),
    runs as (select doc_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run from found where length(raw) >= 6),
    hashed as (select run, {SQL_CRC.format(bytes=SQL_BYTES.format(text="concat(doc_id, ':', run)"))} as h from runs, crc_table),
    words as (
        select case when h % 199 = 0 then substr(run, 1, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) else run end as word, count(*) as n
        from hashed group by 1 having length(word) >= 6 and count(*) >= 5),
    cuts as (select word, n, i, substr(word, 1, i::int) || substr(word, i::int + 2) as rest from words, lateral (select unnest(range(length(word))) as i)),
    pairs as (
        select c.word, w.word as near, w.n as near_n from cuts c join words w on c.rest = w.word
        union select w.word, c.word, c.n from cuts c join words w on c.rest = w.word
        union select a.word, b.word, b.n from cuts a join cuts b on a.rest = b.rest and a.i = b.i and a.word <> b.word),
    best as (select word, count(*) as n_near, first(near order by near_n desc, near) as near, max(near_n) as near_n from pairs group by word),
    forms as (
        select words.word, n, coalesce(n_near, 0) as n_near, case when near_n >= 5 * n then near end as form, case when near_n >= 5 * n then near_n end as form_n
        from words left join best on words.word = best.word),
    chain as (
        select word, word as root, form as further from forms
        union all
        select chain.word, forms.word, forms.form from chain join forms on chain.further = forms.word)
    select forms.word, n, n_near, form, form_n::bigint as form_n, root
    from forms join chain on forms.word = chain.word and chain.further is null
    """,
)
def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents"))


SQL_LEAF = " || ".join(f"coalesce(strlen({c}::varchar) || ':' || {c}, '-')" for c in ("doc_id", "source", "lang", "{n_chars}", "text"))


@query(
    "op13_merkle_manifest",
    rf"""
    with recursive crc_table as ({SQL_CRC_TABLE}),
    leaves as (
        select doc_id, lang, row_number() over (partition by lang order by doc_id) - 1 as pos, sha256({SQL_LEAF.format(n_chars="n_chars")}) as leaf,
            case when {SQL_CRC.format(bytes=SQL_BYTES.format(text="doc_id::varchar"))} % 7 = 0 then sha256({SQL_LEAF.format(n_chars="(n_chars + 1)")}) end as other
        from documents, crc_table),
    nodes as (
        select lang, 0 as level, pos, leaf as digest, count(*) over (partition by lang) as n from leaves
        union all
        select lang, level + 1, pos // 2, sha256(string_agg(digest, '' order by pos)), (any_value(n) + 1) // 2
        from nodes where n > 1 group by lang, level, pos // 2),
    subroots as (select lang, level, digest as subroot, row_number() over (order by lang nulls first) - 1 as place from nodes where n = 1),
    heads as (
        select 0 as level, place as pos, subroot as digest, count(*) over () as n from subroots
        union all
        select level + 1, pos // 2, sha256(string_agg(digest, '' order by pos)), (any_value(n) + 1) // 2
        from heads where n > 1 group by level, pos // 2),
    top as (select digest as root, level from heads where n = 1),
    steps as (
        select leaves.lang, leaves.pos, s.level, place, subroot, root, s.level + top.level as levels, unnest(range(s.level + top.level)) as step
        from leaves join subroots s on leaves.lang is not distinct from s.lang, top),
    beside as (
        select t.lang, t.pos, t.step, (case when t.step < t.level then t.pos >> t.step else t.place >> (t.step - t.level) end) & 1 as side,
            coalesce(n.digest, h.digest, '') as sibling
        from steps t
        left join nodes n on t.step < t.level and n.lang is not distinct from t.lang and n.level = t.step and n.pos = xor(t.pos >> t.step, 1)
        left join heads h on t.step >= t.level and h.level = t.step - t.level and h.pos = xor(t.place >> (t.step - t.level)::int, 1)),
    proofs as (
        select lang, pos, list({{'side': side, 'sibling': sibling}} order by step) as path, sha256(string_agg(sibling, '' order by step)) as proof_sha256
        from beside group by lang, pos)
    select doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) as proof_sha256,
        list_reduce(coalesce(path, []), lambda d, x: {{'side': 0, 'sibling': sha256(case when x.side = 1 then x.sibling || d.sibling else d.sibling || x.sibling end)}}, {{'side': 0, 'sibling': coalesce(other, leaf)}}).sibling as folded_root,
        folded_root = root as verified
    from leaves l join subroots s on l.lang is not distinct from s.lang left join proofs p on l.lang is not distinct from p.lang and l.pos = p.pos, top
    """,
)
def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    tampered = [*fields[:3], F.col("n_chars") + 1, fields[4]]
    candidate = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return manifest.manifest(docs, fields, "lang", "doc_id", candidate, tampered)
