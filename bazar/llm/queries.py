"""The registered queries of the operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazar.llm import decontaminate, fill_in_middle, filter_audit, html_text, language_id, mixing, quality_rules, simhash, substring_dedup, suffix_dedup, suffix_tree_lm, token_counts, toxicity
from bazar.llm.tables import prepared

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


def register(name: str, sql: str | None = None):
    def add(run: Query) -> Query:
        QUERIES[name] = lambda spark, folder: run(prepared(spark), folder)
        if sql is not None:
            ORACLE[name] = sql
        return run

    return add


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet").select(*columns)


@register("op10_token_counts")
def _(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = token_counts.Vocabulary.load(VOCABULARY)
    return token_counts.count_tokens(table(spark, folder, "documents", "doc_id", "text"), vocabulary, keep=["doc_id"])


WORDS_SQL = r"""
    coalesce(regexp_extract_all("text", '[^\x20\x09-\x0D]+'), []::varchar[])
"""


@register(
    "op4_quality_rules",
    rf"""
    with docs as (select doc_id, coalesce("text", '') as body, {WORDS_SQL} as words from documents),
    windows as (
        select doc_id, i, count(*) over (partition by doc_id, array_to_string(words[i:i + 7], ' ')) as copies
        from (select doc_id, words, unnest(generate_series(1, len(words) - 7)) as i from docs where len(words) >= 8)),
    repeated as (
        select doc_id, count(distinct p) as n
        from (select doc_id, unnest(generate_series(i, i + 7)) as p from windows where copies > 1) group by doc_id),
    lines as (
        select doc_id, sum(n) as n_lines, sum(n - 1) as n_dup
        from (select doc_id, line, count(*) as n from (select doc_id, unnest(string_split(body, chr(10))) as line from docs)
              where regexp_matches(line, '[^\x20\x09-\x0D]') group by all) group by doc_id),
    measured as (
        select doc_id, len(words)::bigint as n_words, length(array_to_string(words, ''))::bigint as word_chars,
            length(regexp_replace(body, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols, coalesce(n_dup, 0)::bigint as n_dup_lines,
            coalesce(repeated.n, 0)::bigint as n_repeat_words, coalesce(n_lines, 0)::bigint as n_lines
        from docs left join repeated using (doc_id) left join lines using (doc_id)),
    judged as (
        select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
            (case when n_words < 20 then 1 else 0 end + case when 100 * n_repeat_words > 30 * n_words then 2 else 0 end
             + case when 100 * n_symbols > 10 * word_chars then 4 else 0 end + case when 100 * n_dup_lines > 30 * n_lines then 8 else 0 end
             + case when word_chars < 2 * n_words then 16 else 0 end + case when word_chars > 25 * n_words then 32 else 0 end
             + case when n_dup_lines >= 3 and 100 * n_dup_lines > 30 * n_lines then 64 else 0 end)::bigint as failure_bits
        from measured)
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, failure_bits & ~8 = 0 as kept, failure_bits,
        '{quality_rules.CURRENT}' as policy_version
    from judged""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    entries = quality_rules.ledger(table(spark, folder, "documents", "doc_id", "text"), keep=["doc_id"])
    fails = quality_rules.fails
    base = fails(quality_rules.POLICIES["base"])
    return entries.select(
        "doc_id",
        *quality_rules.MEASURES[:5],
        base.alias("base_failed"),
        (~base & ~fails(quality_rules.POLICIES[quality_rules.CURRENT])).alias("kept"),
        "failure_bits",
        F.lit(quality_rules.CURRENT).alias("policy_version"),
    )


@register("op6_source_mixing")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_sources(table(spark, folder, "documents", "doc_id", "source"))


@register(
    "op7_decontamination",
    r"""
    with docs as (
        select doc_id, regexp_extract_all(translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from documents),
    items as (
        select item_id, regexp_extract_all(translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from benchmark),
    grams as (
        select distinct item_id, least(10, len(words)) as size, array_to_string(words[i:i + least(10, len(words)) - 1], ' ') as gram
        from (select item_id, words, unnest(generate_series(1, len(words) - least(10, len(words)) + 1)) as i from items where len(words) > 0)),
    windows as (
        select doc_id, i, size, array_to_string(words[i:i + size - 1], ' ') as gram
        from (select doc_id, words, size, unnest(generate_series(1, len(words) - size + 1)) as i
              from docs cross join (select distinct size from grams) where len(words) >= size)),
    hits as (select doc_id, i, windows.size, item_id from windows join grams on windows.gram = grams.gram and windows.size = grams.size),
    hit_words as (select doc_id, count(distinct p) as n from (select doc_id, unnest(generate_series(i, i + size - 1)) as p from hits) group by doc_id),
    found as (
        select doc_id, count(*) as n, string_agg(item, ',' order by item) as ids
        from (select distinct doc_id, item_id::varchar as item from hits) group by doc_id)
    select doc_id, len(words)::bigint as n_words, coalesce(hit_words.n, 0)::bigint as n_hit, coalesce(found.n, 0)::bigint as n_items,
        sha256(coalesce(ids, '')) as items_sha256, coalesce(hit_words.n, 0) > 0 as contaminated
    from docs left join hit_words using (doc_id) left join found using (doc_id)""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text")
    found = decontaminate.find_leaks(docs, table(spark, folder, "benchmark", "item_id", "text"), keep=["doc_id"], unnamed=True)
    ids = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id",
        "n_words",
        F.size("hit_words").cast("bigint").alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"),
        (F.size("hit_words") > 0).alias("contaminated"),
    )


@register("op9_html_extraction")
def _(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages", "page_id", "url", "html")
    return html_text.extract(pages, html_text.fit(pages), keep=["page_id", "url"])


@register("op5_toxicity")
def _(spark: SparkSession, folder: str) -> DataFrame:
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    docs = table(spark, folder, "documents", "doc_id", "text")
    labels = table(spark, folder, "labels", "doc_id", "toxic").filter(fold != 0)
    network = toxicity.fit(docs, labels)
    scored = toxicity.score(docs, network, keep=["doc_id"])
    return scored.select("doc_id", (fold == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@register(
    "op1_substring_dedup",
    rf"""
    with docs as (select doc_id, {WORDS_SQL} as words from documents),
    grams as (
        select doc_id, i, array_to_string(words[i:i + 19], ' ') as gram
        from (select doc_id, words, unnest(generate_series(1, len(words) - 19)) as i from docs where len(words) >= 20)),
    lost as (select doc_id, i from (select doc_id, i, row_number() over (partition by gram order by doc_id, i) as nth from grams) where nth > 1),
    marked as (select doc_id, i, coalesce(i - lag(i) over (partition by doc_id order by i), 21) > 20 as opens from lost),
    spans as (
        select doc_id, min(i) as a, max(i) + 20 as b
        from (select doc_id, i, count(*) filter (where opens) over (partition by doc_id order by i) as span from marked) group by doc_id, span),
    gaps as (
        select doc_id, coalesce(lag(b) over (partition by doc_id order by a), 1) as first, a - 1 as last from spans
        union all select docs.doc_id, coalesce(max(b), 1), any_value(len(words)) from docs left join spans using (doc_id) group by docs.doc_id),
    kept as (
        select doc_id, string_agg(array_to_string(words[first:last], ' '), ' ' order by first) as body, sum(last - first + 1) as n
        from gaps join docs using (doc_id) where last >= first group by doc_id)
    select doc_id, len(words)::bigint as n_words, (len(words) - coalesce(n, 0))::bigint as n_removed, sha256(coalesce(body, '')) as kept_sha256
    from docs left join kept using (doc_id)""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    done = substring_dedup.substring_dedup(table(spark, folder, "documents", "doc_id", "text"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@register("op3_simhash")
def _(spark: SparkSession, folder: str) -> DataFrame:
    done = simhash.near_duplicates(table(spark, folder, "documents", "doc_id", "text"))
    return done.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


@register(
    "op8_suffix_dedup",
    """
    with docs as (select doc_id, hex(encode(coalesce("text", ''))) as h from documents),
    blocks as (  -- the engine counts characters from the start of a string, so long ones are cut first
        select doc_id, 1000 * j as base, substr(h, 2000 * j + 1, 2098) as block
        from (select doc_id, h, unnest(generate_series(0, length(h) // 2000)) as j from docs)),
    grams as (
        select doc_id, base + i as i, substr(block, 2 * i + 1, 100) as gram
        from (select doc_id, base, block, unnest(generate_series(0, length(block) // 2 - 50)) as i from blocks where length(block) >= 100)),
    firsts as (select gram, min(doc_id) as least from grams group by gram having count(*) > 1),
    lost as (select doc_id, i from grams join firsts using (gram) where least < doc_id),
    marked as (select doc_id, i, coalesce(i - lag(i) over (partition by doc_id order by i), 51) > 50 as opens from lost),
    spans as (
        select doc_id, min(i) as a, max(i) + 50 as b
        from (select doc_id, i, count(*) filter (where opens) over (partition by doc_id order by i) as span from marked) group by doc_id, span),
    gaps as (
        select doc_id, coalesce(lag(b) over (partition by doc_id order by a), 0) as a, a as b from spans
        union all select docs.doc_id, coalesce(max(b), 0), any_value(length(h) // 2) from docs left join spans using (doc_id) group by docs.doc_id),
    kept as (select doc_id, string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' order by a) as body, count(*) - 1 as n_spans from gaps join docs using (doc_id) group by doc_id)
    select doc_id, (length(h) // 2)::bigint as n_bytes, ((length(h) - length(body)) // 2)::bigint as n_removed, n_spans::bigint as n_spans, sha256(unhex(body)) as kept_sha256
    from docs join kept using (doc_id)""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    done = suffix_dedup.suffix_dedup(table(spark, folder, "documents", "doc_id", "text"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256"))


@register("op2_suffix_tree_lm")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_tree_lm.score(table(spark, folder, "documents", "doc_id", "text")).drop("text")


@register(
    "op11_fill_in_middle",
    r"""
    with docs as (
        select doc_id, coalesce("text", '') as body, sha256('7:' || coalesce(doc_id::varchar, '')) as digest,
            coalesce(regexp_extract_all(coalesce("text", ''), '[^\n]*\n|[^\n]+'), []::varchar[]) as units
        from documents),
    drawn as (
        select *, len(units) as n, ('0x' || substr(digest, 1, 8))::bigint % (len(units) + 1) as c1, ('0x' || substr(digest, 9, 8))::bigint % (len(units) + 1) as c2,
            ('0x' || substr(digest, 17, 8))::bigint as h3, ('0x' || substr(digest, 25, 8))::bigint as h4
        from docs),
    parts as (
        select doc_id, body, n, array_to_string(units[:least(c1, c2)], '') as prefix, array_to_string(units[least(c1, c2) + 1:greatest(c1, c2)], '') as middle,
            array_to_string(units[greatest(c1, c2) + 1:], '') as suffix,
            case when body = '' or contains(body, '<P>') or contains(body, '<S>') or contains(body, '<M>') or h3 % 100 >= 100 then 'plain' when h4 % 100 < 50 then 'spm' else 'psm' end as form
        from drawn)
    select doc_id, n::bigint as n, form, case when form <> 'plain' then length(prefix) end::bigint as prefix_chars, case when form <> 'plain' then length(middle) end::bigint as middle_chars,
        sha256(case form when 'plain' then body when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
        sha256(body) as restored_sha256
    from parts""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    done = fill_in_middle.fill_in_middle(table(spark, folder, "documents", "doc_id", "text"), keep=["doc_id"])
    return done.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(fill_in_middle.restored(), 256).alias("restored_sha256")
    )


@register(
    "op12_filter_audit",
    rf"""
    with docs as (select doc_id, coalesce("source", '') as part, coalesce("text", '') as body, {WORDS_SQL} as words from documents),
    flags as (select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels group by doc_id),
    failing as (
        select part, (case when len(words) < 50 then 1 else 0 end + case when 100 * len(list_distinct(words)) < 65 * len(words) then 2 else 0 end
            + case when 100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 5 * length(body) then 4 else 0 end
            + case when regexp_matches(body, '[#$%&*|]') then 8 else 0 end
            + case when doc_id > min(doc_id) over (partition by body) then 16 else 0 end) as failed,
            coalesce(good, 0) as good, coalesce(toxic, 0) as toxic
        from docs left join flags using (doc_id)),
    counted as (select part, failed, count(*) as n, sum(good) as good, sum(toxic) as toxic from failing group by all),
    letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as l, unnest([1, 2, 4, 8, 16]) as bit),
    orders as (
        select a.l || b.l || c.l || d.l || e.l as filter_order from letters a, letters b, letters c, letters d, letters e
        where a.bit + b.bit + c.bit + d.bit + e.bit = 31 and a.bit | b.bit | c.bit | d.bit | e.bit = 31),
    steps as (
        select filter_order, step, l, bit, (select coalesce(sum(o.bit), 0) from letters o where instr(filter_order, o.l) < step) as before
        from orders, (select unnest([1, 2, 3, 4, 5])::int as step), letters where substr(filter_order, step, 1) = l),
    audited as (
        select part, filter_order, step, l, sum(n) filter (where failed & (before + bit) = 0) as kept, sum(n) filter (where failed & before = 0 and failed & bit <> 0) as removed,
            sum(n) filter (where failed & before <> 0 and failed & bit <> 0) as redundant, sum(n) filter (where failed = bit) as unique_fails,
            sum(good) filter (where failed & before = 0 and failed & bit <> 0) as good_lost, sum(toxic) filter (where failed & before = 0 and failed & bit <> 0) as toxic_lost
        from counted, (select filter_order, step, l, bit::int as bit, before::int as before from steps) group by part, filter_order, step, l)
    select part, filter_order, step, coalesce(kept, 0)::bigint as kept, coalesce(removed, 0)::bigint as removed, coalesce(redundant, 0)::bigint as redundant,
        coalesce(unique_fails, 0)::bigint as unique_fails, coalesce(good_lost, 0)::bigint as good_lost, coalesce(toxic_lost, 0)::bigint as toxic_lost,
        (sum(coalesce(removed, 0)) over (partition by part, l))::bigint as shapley
    from audited""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit(table(spark, folder, "documents", "doc_id", "text", "source"), table(spark, folder, "labels", "doc_id", "quality", "toxic"))


@register("op13_language_id")
def _(spark: SparkSession, folder: str) -> DataFrame:
    fold = F.crc32(F.col("doc_id").cast("string")) % 4
    model = language_id.fit(table(spark, folder, "documents", "doc_id", "text", "lang").filter(fold != 2))
    done = language_id.predict(table(spark, folder, "documents", "doc_id", "text"), model, keep=["doc_id"])
    return done.select("doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")
