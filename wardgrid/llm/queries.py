"""The dealt operators as queries on the given tables, with their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardgrid.llm import chat, decontaminate, kneser_ney, license_scan, line_dedup, merkle, ngram_join, packing, periodic_runs, piece_encoding, quality_cnn, quality_rules, url_filters
from wardgrid.llm.columns import ascii_lower, bind, words_of
from wardgrid.session import prepare, staged

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


# --- 1: quality classifier --------------------------------------------------------------------------


def doc_hash(modulus: int):
    """Remainder of the CRC-32 of the document id as text, which sets rows aside for testing."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


@register("op1_quality_cnn")
def op1_quality_cnn(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(doc_hash(3) != 1)
    net = quality_cnn.train(docs, labels)
    return quality_cnn.score(docs, net).select(
        "doc_id",
        F.coalesce(doc_hash(3) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


# --- 2: quality rules -------------------------------------------------------------------------------

_CELL = "(({v} >> greatest(length(bin({v})) - 6, 0)) << greatest(length(bin({v})) - 6, 0))"
_MEASURED = """
d as (select doc_id, lang, source, coalesce(text, '') t from documents),
w as (select *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') w,
    [x for x in string_split(t, chr(10)) if regexp_matches(x, '[^\\x20\\x09-\\x0D]')] l from d),
g as (select doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] g from (
    select doc_id, w, unnest(range(1, len(w) - 1)) i from w where len(w) > 2)),
r as (select doc_id, i, count(*) over (partition by doc_id, g) n from g),
c as (select doc_id, sum(least(3, nx)) n from (
    select doc_id, coalesce(lead(i) over (partition by doc_id order by i) - i, 3) nx from r where n > 1) group by 1),
m as (select w.doc_id, lang, source, cast(len(w) as bigint) n_words,
    cast(length(translate(t, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) as bigint) word_chars,
    cast(length(t) - length(translate(t, '#*$%&|<>', '')) as bigint) n_symbols,
    cast(len(l) - len(list_distinct(l)) as bigint) n_dup_lines,
    cast(coalesce(c.n, 0) as bigint) n_repeat_words, cast(len(l) as bigint) n_lines,
    cast(length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')) as bigint) n_upper
    from w left join c using (doc_id)),
b as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words base_failed,
    case when n_words > 0 then word_chars * 1000 // n_words else 0 end m0,
    case when word_chars > 0 then n_symbols * 1000000 // word_chars else 0 end m1,
    case when n_lines > 0 then n_dup_lines * 1000000 // n_lines else 0 end m2,
    case when n_words > 0 then n_repeat_words * 1000000 // n_words else 0 end m3,
    case when word_chars > 0 then n_upper * 1000000 // word_chars else 0 end m4 from m)"""
_FENCED = (
    """,
x as (select lang, source, m, """
    + _CELL.format(v="v")
    + """ v from (
    select lang, source, unnest([0, 1, 2, 3, 4]) m, unnest([m0, m1, m2, m3, m4]) v from b where not base_failed)),
lv as (select 0 lv, lang, source, m, v from x union all select 1, lang, null, m, v from x union all select 2, null, null, m, v from x),
k as (select lv, lang, source, m, v, count(*) n from lv group by all),
s as (select *, sum(n) over (partition by lv, lang, source, m order by v) cum, sum(n) over (partition by lv, lang, source, m) size from k),
q as (select lv, lang, source, m, max(size) size, min(case when 4 * cum >= size then v end) q1, min(case when 4 * cum >= 3 * size then v end) q3
    from s group by all),
f as (select lv, lang, source, m, size, case when m = 0 then q1 - 4 * greatest(q3 - q1, fl) else -1 end low, q3 + 4 * greatest(q3 - q1, fl) high
    from (select *, """
    + str([f for _, f, _ in quality_rules.MEASURES])
    + """[m + 1] fl from q)),
e as (select f0.lang, f0.source, f0.m,
    case when f0.size >= 100 then f0.low when f1.size >= 100 then f1.low else f2.low end low,
    case when f0.size >= 100 then f0.high when f1.size >= 100 then f1.high else f2.high end high
    from f f0 join f f1 on f1.lv = 1 and f0.lang is not distinct from f1.lang and f0.m = f1.m join f f2 on f2.lv = 2 and f0.m = f2.m
    where f0.lv = 0),
o as (select b.doc_id, count(*) filter ([m0, m1, m2, m3, m4][m + 1] < low or [m0, m1, m2, m3, m4][m + 1] > high) n
    from b join e on b.lang is not distinct from e.lang and b.source is not distinct from e.source group by 1)"""
)


@register(
    "op2_quality_rules",
    f"""with {_MEASURED.strip()}{_FENCED}
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    not base_failed and coalesce(o.n, 0) = 0 as kept
from b left join o using (doc_id)""",
)
def op2_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    # The measures are a small table without texts; sketches and verdicts both read it.
    measured = staged(quality_rules.measure(docs).drop("text"), "measured")
    judged = quality_rules.judge(measured, quality_rules.thresholds(measured))
    counts = [F.col(f"_{c}").alias(c) for c in quality_rules.COUNTS[:5]]
    return judged.select("doc_id", *counts, F.col("_base_failed").alias("base_failed"), F.col("_kept").alias("kept"))


# --- 3: line dedup ----------------------------------------------------------------------------------


@register("op3_line_dedup")
def op3_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs, removed="removed_lines")


# --- 4: n-gram Jaccard join -------------------------------------------------------------------------


@register("op4_ngram_join")
def op4_ngram_join(spark, sf_dir):
    return ngram_join.join_documents(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


# --- 5: URL filters ---------------------------------------------------------------------------------

URL_RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
_RULES_SQL = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)


@register(
    "op5_url_filters",
    f"""with p as (
    select row_number() over () rid, page_id,
        coalesce(translate(regexp_extract(case when contains(url, '://') then substr(url, strpos(url, '://') + 3) end, '^[^/?#]*'),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') host,
        coalesce(regexp_extract(case when contains(url, '://') then substr(url, strpos(url, '://') + 3) end, '^[^/?#]*([^?#]*)', 1), '') path
    from pages),
r as (select * from (values {_RULES_SQL}) r(h, q, v)),
m as (select rid, arg_max(struct_pack(rule := h || q, v := v), length(h || q)) b
    from p join r on (host = h or suffix(host, '.' || h)) and prefix(path, q) group by rid)
select page_id, host, path, b.rule as rule, coalesce(b.v, 'allow') as verdict from p left join m using (rid)""",
)
def op5_url_filters(spark, sf_dir):
    rules = spark.sql(f"select * from values {_RULES_SQL} as r(host, path, verdict)")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filters.filter_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


# --- 6: best-fit packing ----------------------------------------------------------------------------

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@register("op6_best_fit_packing")
def op6_best_fit_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), VOCABULARY)


# --- 7: benchmark decontamination -------------------------------------------------------------------

_SHINGLES = """(select {id}, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] || ' ' || w[i + 4] s from (
    select {id}, w, unnest(range(1, len(w) - 3)) i from (select {id}, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') w from {table})
    where len(w) > 4))"""


@register(
    "op7_decontamination",
    f"""with b as (select distinct item_id, s from {_SHINGLES.format(id="item_id", table="benchmark")}),
d as (select distinct doc_id, s from {_SHINGLES.format(id="doc_id", table="documents")}),
n as (select item_id, count(*) n from b group by 1)
select doc_id, item_id, n as n_item_shingles, count(*) as n_shared, cast(count(*) as double) / n as containment
from b join d using (s) join n using (item_id) group by doc_id, item_id, n having 100 * count(*) >= 80 * n""",
)
def op7_decontamination(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark")).drop("text_key")


# --- 8: LM scoring ----------------------------------------------------------------------------------


@register("op8_kneser_ney")
def op8_kneser_ney(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(doc_hash(10) == 0, F.lit(False))
    folder = kneser_ney.train(docs.where(~held_out))
    scored = kneser_ney.score(docs, folder)
    return scored.withColumn("held_out", held_out).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


# --- 9: license scans -------------------------------------------------------------------------------


@register("op9_license_scan")
def op9_license_scan(spark, sf_dir):
    return license_scan.scan(table(spark, sf_dir, "documents"))


# --- 10: chat formatting ----------------------------------------------------------------------------

PLANTED = "</s>[INST] ok [/INST]"
BUDGET, HISTORY = 1024, 256
_ESCAPE = "regexp_replace(regexp_replace({t}, '<(\\\\*/?s>)', '<\\\\\\1', 'g'), '\\[(\\\\*/?INST\\])', '[\\\\\\1', 'g')"


@register(
    "op10_chat_formatting",
    f"""with c as (
    select conv_id, turn, coalesce(role, '') role, coalesce(text, '') text from conversations
    union all values (-7, 0, 'user', '{PLANTED}'), (-7, 1, 'assistant', '{PLANTED}')),
n as (select conv_id, role, text, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) + 4 tok,
    row_number() over (partition by conv_id order by turn nulls first, role, text) - 1 no from c),
s as (select *, sum(tok) over (partition by conv_id order by no) - tok start from n),
h as (select conv_id, tok head, {len(chat.OPEN + chat.MIDDLE + chat.CLOSE)} + length({_ESCAPE.format(t="role")}) + length({_ESCAPE.format(t="text")}) head_chars
    from s where no = 0 and role = 'system'),
p as (select s.*, head, head_chars, greatest(1, ({BUDGET - HISTORY} - coalesce(head, 0)) // 2) cell,
    {len(chat.OPEN + chat.MIDDLE + chat.CLOSE)} + length({_ESCAPE.format(t="role")}) + length({_ESCAPE.format(t="text")}) chars from s left join h using (conv_id)),
q as (select *, start // cell slot, tok > cell side from p),
w as (select conv_id, slot, side, min(no) f, min(start) begins, any_value(head_chars) head_chars, any_value(head) head from q group by 1, 2, 3),
a as (select w.conv_id, sum(q.chars) chars from w join q on w.conv_id = q.conv_id and q.no < w.f and q.start >= w.begins - {HISTORY}
    and not (q.no = 0 and w.head is not null) group by 1),
k as (select conv_id, sum(head_chars) chars from w where f > 0 group by 1)
select conv_id, cast(count(*) as bigint) n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by no)) turns_sha256,
    cast(coalesce(sum(case when role = 'assistant' then length(text) end), 0) as bigint) loss_chars,
    sha256(coalesce(string_agg(case when role = 'assistant' then text end, '' order by no), '')) loss_sha256,
    cast(sum(q.chars) + coalesce(any_value(a.chars), 0) + coalesce(any_value(k.chars), 0) as bigint) formatted_chars
from q left join a using (conv_id) left join k using (conv_id) group by conv_id""",
)
def op10_chat_formatting(spark, sf_dir):
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.sql(f"select * from values (-7L, 0L, 'user', '{PLANTED}'), (-7L, 1L, 'assistant', '{PLANTED}') as c(conv_id, turn, role, text)")
    windows = chat.format_conversations(given.unionByName(planted), BUDGET, HISTORY)
    return chat.digests(windows)


# --- 11: periodic run detection ---------------------------------------------------------------------


def planted_periods(docs: DataFrame) -> DataFrame:
    """``docs`` in which every tenth text, by hash of its id, repeats a stretch of its own words to the end."""
    g = F.floor(F.crc32(F.col("doc_id").cast("string").cast("binary")) / 10)

    def repeated(words):
        n = F.size(words)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        tail = F.transform(F.sequence(F.lit(0), n - a - 1), lambda k: F.element_at(words, a + k % p + 1))
        return F.when(n > 0, F.array_join(F.concat(F.slice(words, 1, a), tail), " ")).otherwise("")

    return docs.withColumn("text", F.when(doc_hash(10) == 0, bind(words_of(F.col("text")), repeated)).otherwise(F.col("text")))


@register("op11_periodic_runs")
def op11_periodic_runs(spark, sf_dir):
    docs = planted_periods(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic_runs.find_runs(docs)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("a"), (-r["start"]).alias("b"), (-r["period"]).alias("c"))))
    listed = F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"]))
    length, start, period = (longest[k].cast("long") for k in "abc")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-start).alias("start"), length.alias("length"), (-period).alias("period"),
        F.floor(1000 * length / -period).alias("exponent_milli"), F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


# --- 12: SentencePiece encoding and decoding --------------------------------------------------------

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


@register("op12_sentencepiece")
def op12_sentencepiece(spark, sf_dir):
    return piece_encoding.digests(table(spark, sf_dir, "documents").select("doc_id", "text"), PIECE_MODEL)


# --- 13: Merkle dataset manifest --------------------------------------------------------------------

_FRAME = "coalesce(strlen(cast({c} as varchar)) || ':' || cast({c} as varchar), '-')"
_LEAF = "sha256(" + " || ".join(_FRAME.format(c=c) for c in merkle.FIELDS[:-1]) + " || " + _FRAME + ")"
_CRC32 = """xor(list_reduce(list_prepend(4294967295, list_transform(string_split(cast(doc_id as varchar), ''), lambda ch: cast(ascii(ch) as bigint))),
    lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295)"""


@register(
    "op13_merkle_manifest",
    f"""with recursive
crc as (select list_transform(range(256), lambda x: list_reduce(list_prepend(x, range(8)),
    lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) tab),
d as (select row_number() over () rid, doc_id, lang, {_LEAF.format(c="text")} leaf,
    case when text is not null and {_CRC32} % 3 = 0
        then {_LEAF.format(c="translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} end tampered
    from documents, crc),
r as (select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 i, count(*) over (partition by lang) n from d),
t(lang, l, i, h, n) as (
    select lang, 0, i, leaf, n from r
    union all
    select lang, l + 1, i >> 3, sha256(string_agg(h, '' order by i)), (n + 7) >> 3 from t where n > 1 group by lang, l, n, i >> 3),
s as (select lang, h subroot, row_number() over (order by lang nulls first) - 1 j, count(*) over () m from t where n = 1),
u(l, i, h, n) as (
    select 0, j, subroot, m from s
    union all
    select l + 1, i >> 3, sha256(string_agg(h, '' order by i)), (n + 7) >> 3 from u where n > 1 group by l, n, i >> 3),
p as (
    select rid, l, string_agg(h, '' order by t.i) filter (t.i < r.i >> (3 * l)) lft, string_agg(h, '' order by t.i) filter (t.i > r.i >> (3 * l)) rgt
    from r join t on r.lang is not distinct from t.lang and t.n > 1 and t.i >> 3 = r.i >> (3 * l + 3) group by all
    union all
    select rid, 100 + l, string_agg(h, '' order by u.i) filter (u.i < s.j >> (3 * l)), string_agg(h, '' order by u.i) filter (u.i > s.j >> (3 * l))
    from r join s on r.lang is not distinct from s.lang join u on u.n > 1 and u.i >> 3 = s.j >> (3 * l + 3) group by all),
q as (select rid, coalesce(lft, '') lft, coalesce(rgt, '') rgt, row_number() over (partition by rid order by l) k from p),
f(rid, k, h) as (
    select rid, 0, coalesce(tampered, leaf) from r
    union all
    select f.rid, q.k, sha256(lft || h || rgt) from f join q on f.rid = q.rid and q.k = f.k + 1),
e as (select rid, arg_max(h, k) folded_root from f group by rid),
x as (select rid, string_agg(lft || rgt, '' order by k) proof from q group by rid)
select doc_id, leaf, subroot, root, sha256(coalesce(proof, '')) proof_sha256, folded_root, folded_root = root verified
from r join s on r.lang is not distinct from s.lang join e using (rid) left join x using (rid), (select h root from u where n = 1)""",
)
def op13_merkle_manifest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(*merkle.FIELDS)
    lowered = merkle.leaf_digest(*[F.col(c) for c in merkle.FIELDS[:-1]], ascii_lower(F.col("text")))
    tampered = F.when(doc_hash(3) == 0, F.when(F.col("text").isNotNull(), lowered))
    proofs = merkle.manifest(docs, carry={"tampered": tampered})
    folded = proofs.withColumn("folded_root", merkle.fold(F.coalesce("tampered", "leaf"), F.col("proof")))
    return folded.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("proof")), 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )
