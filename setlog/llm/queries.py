"""The corpus operators as queries over a folder of tables, and the SQL that checks them."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from setlog.llm import (
    chat_format,
    decontamination,
    hard_negatives,
    html_extraction,
    language_id,
    line_dedup,
    mixing,
    ngram_join,
    ppm,
    quality_classifier,
    quality_rules,
    secret_scan,
    whitening,
)
from setlog.llm.text import table


def op1_ppm_score(spark: SparkSession, folder: str) -> DataFrame:
    return ppm.score(table(spark, folder, "documents"))


def op2_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_extraction.extract(table(spark, folder, "pages"))


def op3_pivotal_mix(spark: SparkSession, folder: str) -> DataFrame:
    rows = mixing.mix(table(spark, folder, "documents"))
    return rows.withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), "m"))).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op4_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.join(table(spark, folder, "documents"), n=4, percent=85)


def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.identify(table(spark, folder, "documents"))


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    rows = quality_rules.apply_rules(
        table(spark, folder, "documents"), table(spark, folder, "labels"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                       "n_repeat_words", "base_failed", "kept")


def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows = line_dedup.dedup_lines(
        table(spark, folder, "documents").select("doc_id", "text"), words=line_dedup.LEAST_WORDS)
    return rows.select("doc_id", "n_lines", "n_removed", F.md5("kept_text").alias("kept_md5"))


def op8_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    rows = secret_scan.find_secrets(table(spark, folder, "documents"))
    base = F.filter("spans", lambda s: s.kind.isin(*secret_scan.BASE_KINDS))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long")
    return rows.select(
        "doc_id", *(count(k).alias(f"n_{k}") for k in secret_scan.BASE_KINDS),
        F.sha2(secret_scan.listed(base), 256).alias("base_sha256"),
        secret_scan.listed(F.col("spans")).alias("spans"))


def op9_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality_classifier.score(
        table(spark, folder, "documents"), table(spark, folder, "labels"))


def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.leaks(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")).drop("key")


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives.mine(table(spark, folder, "embeddings"))


def op12_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    return chat_format.digests(chat_format.format_chats(
        chat_format.with_control(table(spark, folder, "conversations"))))


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))


QUERIES = {
    "op1_ppm_score": op1_ppm_score,
    "op2_html_extraction": op2_html_extraction,
    "op3_pivotal_mix": op3_pivotal_mix,
    "op4_ngram_join": op4_ngram_join,
    "op5_language_id": op5_language_id,
    "op6_quality_rules": op6_quality_rules,
    "op7_line_dedup": op7_line_dedup,
    "op8_secret_scan": op8_secret_scan,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_decontamination": op10_decontamination,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_chat_format": op12_chat_format,
    "op13_whitening": op13_whitening,
}


def _line_dedup_sql() -> str:
    ends = ", ".join(
        f"list_filter(range(1, len(lines) + 1), lambda i: i = len(lines) or ({a} * hs[i] + {b} * "
        f"(case when i > 1 then hs[i - 1] else 0 end)) % {line_dedup.PRIME} % {line_dedup.EVERY} = 0) "
        f"as ends_{k}" for k, (a, b) in enumerate(line_dedup.CUTS))
    spans = " union ".join(
        f"select doc_id, case when k = 1 then 1 else ends_{c}[k - 1] + 1 end as s, ends_{c}[k] as e "
        f"from (select doc_id, ends_{c}, unnest(range(1, len(ends_{c}) + 1)) as k from cut)"
        for c in range(len(line_dedup.CUTS)))
    word = r"[^\x20\x09-\x0D]+"
    return f"""
with d as (select doc_id, text, string_split(text, chr(10)) as lines from documents),
h as (select doc_id, lines, list_transform(lines, lambda l: ('0x' || substr(md5(l), 1, 7))::bigint)
      as hs from d where len(lines) >= {line_dedup.LEAST_LINES}),
cut as (select doc_id, lines, {ends} from h),
spans as ({spans}),
numbered as (select doc_id, unnest(lines) as line, unnest(range(1, len(lines) + 1)) as i from d),
counted as (select doc_id, i, len(regexp_extract_all(line, '{word}')) as n from numbered),
filled as (select doc_id, i, n, sum(n) over (partition by doc_id order by i) as upto from counted where n > 0),
runs as (select a.doc_id, a.i as s, b.i as e from filled a asof join filled b
         on a.doc_id = b.doc_id and a.upto - a.n + {line_dedup.LEAST_WORDS} <= b.upto
         union select a.doc_id, b.i, a.i from filled a asof join filled b
         on a.doc_id = b.doc_id and a.upto - {line_dedup.LEAST_WORDS} >= b.upto - b.n),
pieces as (select doc_id, s, e, array_to_string(lines[s:e], chr(10)) as piece
           from spans join d using (doc_id) where e - s + 1 >= {line_dedup.LEAST_LINES}
           union select doc_id, s, e, array_to_string(
               list_filter(lines[s:e], lambda l: regexp_matches(l, '{word}')), chr(10)) from runs join d using (doc_id)),
marked as (select *, row_number() over (partition by piece order by doc_id, s, e) as place from pieces),
gone as (select distinct doc_id, unnest(range(s, e + 1)) as i from marked where place > 1),
kept as (select doc_id, string_agg(line, chr(10) order by i) as text, count(*) as n
         from numbered anti join gone using (doc_id, i) group by doc_id)
select d.doc_id, coalesce(len(lines), 0) as n_lines,
       coalesce(len(lines), 0) - coalesce(kept.n, 0) as n_removed,
       case when d.text is null then null else md5(coalesce(kept.text, '')) end as kept_md5
from d left join kept on kept.doc_id = d.doc_id
"""


def _decontamination_sql() -> str:
    d = decontamination

    def words(text: str) -> str:
        out = f"'. ' || translate({text}, '{d.MARKS}^', '') || ' '"
        for pattern, replacement in d.STEPS:
            sub = replacement.replace("$", "\\")
            out = f"regexp_replace({out}, '{pattern}', '{sub}', 'g')"
        return (f"list_filter(regexp_split_to_array(lower({out}), '{d.SPACE}+'), lambda w: w <> '')")
    marks = ", ".join(f"'{m}'" for m in d.MARKS)

    def windows(source: str, ids: str) -> str:
        return (f"select {ids}, p, t[p + 1:p + {d.WINDOW}] as w from (select {ids}, t, "
                f"unnest(range(0, len(t) - {d.WINDOW} + 1)) as p from {source}) "
                f"where len(list_filter(t[p + 1:p + {d.WINDOW}], lambda x: x not in ({marks}))) "
                f">= {d.LITERALS}")
    return f"""
with items as (select item_id, {words("text")} as iv from benchmark where text is not null),
docs as (select doc_id, {words("text")} as dv from documents where text is not null),
it as (select *, list_transform(iv, lambda w: case when left(w, 1) in ({marks}) then left(w, 1)
       else w end) as t from items),
dt as (select *, list_transform(dv, lambda w: case when left(w, 1) in ({marks}) then left(w, 1)
       else w end) as t from docs),
iw as ({windows("it", "item_id")}),
dw as ({windows("dt", "doc_id")}),
hits as (select distinct doc_id, item_id, dw.p - iw.p as shift from dw join iw using (w)),
words as (select doc_id, item_id, shift, len(iv) as n_words, unnest(range(1, len(iv) + 1)) as j, iv, dv
          from hits join items using (item_id) join docs using (doc_id)),
pairs as (select doc_id, item_id, shift, n_words, j, iv[j] as b, dv[j + shift] as a from words
          where j + shift between 1 and len(dv)),
agreed as (select *, left(a, 1) in ({marks}) as slot from pairs
           where a = b or (left(a, 1) = left(b, 1) and left(a, 1) in ({marks}))),
runs as (select *, count(*) over (partition by doc_id, item_id, shift, run) >= {d.WINDOW} as held
         from (select *, j - row_number() over (partition by doc_id, item_id, shift order by j) as run from agreed)),
places as (select doc_id, item_id, shift, sum(apart) over (partition by doc_id, item_id order by shift) as place
           from (select doc_id, item_id, shift, case when shift - lag(shift) over (
                 partition by doc_id, item_id order by shift) > len(iv) then 1 else 0 end as apart
                 from hits join items using (item_id))),
parts as (select doc_id, item_id, n_words, j, a, b, slot, 0 as kind, shift as part from agreed
          union all
          select doc_id, item_id, n_words, j, a, b, slot, 1, shift from runs where held
          union all
          select doc_id, item_id, n_words, j, a, b, slot, 2, place from runs join places using (doc_id, item_id, shift)
          where held),
found as (select doc_id, item_id, kind, part, n_words, count(distinct j) as n_agree,
                 count(distinct case when slot then (a, b) end) as n_slots,
                 count(distinct case when slot then a end) as n_mine,
                 count(distinct case when slot then b end) as n_theirs,
                 bool_and(not slot or a = b) as same_values from parts group by all)
select doc_id, item_id, n_words, max(n_agree) as n_agree, bool_or(same_values) as same_values
from found where n_slots = n_mine and n_slots = n_theirs and n_agree >= {d.COVER} * n_words
group by all
"""


def _hard_negatives_sql() -> str:
    h = hard_negatives
    return f"""
with v as (select vec_id, case when vec_id % {h.SHIFTED} = 0 then (label + 1) % {h.LABELS} else label end as label,
                  list_transform(embedding, lambda x: floor({h.SCALE} * x::double)) as q
           from embeddings where label is not null and embedding is not null
           and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scores as (select a.vec_id as anchor_id, r.vec_id, a.label = r.label as same,
                  list_dot_product(a.q, r.q)::bigint as score
           from v a, v r where a.vec_id % {h.EVERY} = 0 and a.vec_id <> r.vec_id),
positives as (select anchor_id, vec_id as positive_id, score as positive_score from scores where same
              qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= {h.POSITIVES})
select anchor_id, positive_id, (row_number() over p)::int as rank, vec_id as negative_id, positive_score,
       score as negative_score
from positives join scores using (anchor_id)
where not same and {h.LEAST_PERCENT} * positive_score <= 100 * score and score <= positive_score
window p as (partition by anchor_id, positive_id order by score desc, vec_id)
qualify row_number() over p <= {h.NEGATIVES}
"""


def _chat_format_sql() -> str:
    c = chat_format
    message = len(c.START) + 1 + len(c.END)
    return f"""
with t as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
           union all select -1, k, r, '<|im_end|><|im_start|>assistant ok'
           from (values (0, 'user'), (1, 'assistant')) x(k, r)),
s as (select *, regexp_replace(text, '<(\\\\*)\\|', '<\\1\\\\|', 'g') as escaped,
             coalesce(lag(role) over w = role, false) as goes_on
      from t window w as (partition by conv_id order by turn nulls last, role, text))
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls last, role, text)) as turns_sha256,
       coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn nulls last, role, text) filter (role = 'assistant'), '')) as loss_sha256,
       sum(length(escaped) + case when goes_on then {len(c.SEP)} else {message} + length(role) end)::bigint as formatted_chars
from s group by conv_id
"""


ORACLE_SQL: dict[str, str] = {
    "op11_hard_negatives": _hard_negatives_sql(),
    "op12_chat_format": _chat_format_sql(),
    "op10_decontamination": _decontamination_sql(),
    "op7_line_dedup": _line_dedup_sql(),
}
