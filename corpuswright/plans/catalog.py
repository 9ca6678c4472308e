"""Named queries over the test tables, and the same in DuckDB's SQL."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuswright.functions import pii, quality, text
from corpuswright.operators import blend, calibrate, dedup, hosts, tokens
from corpuswright.plans.clean import clean, reasons
from corpuswright.plans.config import Cleaning
from corpuswright.plans.storage import spread, written
from corpuswright.sources import readers
from corpuswright.streaming.clean import event_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def add(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"))


#: The test documents are in these languages.
LANGUAGES = ("en", "fr", "es", "de")
STOPS = tuple(dict.fromkeys(w for k in LANGUAGES for w in quality.PROFILES[k].split()))
LIMITS = quality.Thresholds(min_avg_word_length=3.0, max_avg_word_length=10.0, stop_words=STOPS)

# ---- SQL pieces

_WS = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_WORD = r"[^\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def sql_words(x: str) -> str:
    return f"regexp_extract_all({x}, '{_WORD}')"


def sql_lower(x: str) -> str:
    return f"lower(translate(replace({x}, 'I' || chr(775), 'i'), 'Iİ', 'ıi'))"


def sql_upper(x: str) -> str:
    # upper case of a sharp s is two letters
    return f"upper(replace(translate({x}, 'iı', 'İI'), 'ß', 'SS'))"


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"


_HORIZONTAL = r"[\t\x0b\f\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def sql_key(x: str) -> str:
    return sql_strip(f"regexp_replace({sql_lower(f'nfc_normalize({x})')}, '{_HORIZONTAL}', ' ', 'g')")


_CONTROLS = r"[\x{0}-\x{8}\x0b\f\x{e}-\x{1f}\x{7f}-\x{9f}\p{Cf}]+"
_NORMAL = f"regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(nfc_normalize(text), '{_CONTROLS}', '', 'g'), '{_HORIZONTAL}', ' ', 'g'), ' +\\n', chr(10), 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g'), '^[ \\n]+|[ \\n]+$', '', 'g')"
_METRICS = f"""select doc_id, lang, source, text, len(w) n_words, list_sum([length(x) for x in {sql_words(sql_lower('text'))}]) / len(w) mean_word_length,
    len(regexp_extract_all(text, '#|…|\\.\\.\\.')) / len(w) symbol_word_ratio, len([x for x in w if not regexp_matches(x, '\\p{{L}}')]) / len(w) non_alpha_words_ratio, w
    from (select *, {sql_words('text')} w from documents) where len(w) > 0"""
_LINES = f"[x for x in [{sql_strip('y')} for y in string_split(text, chr(10))] if x <> '']"


def _sql_stops() -> str:
    return "[" + ", ".join(f"'{w}'" for w in LIMITS.stop_words) + "]"


def _sql_reasons(limits: quality.Thresholds) -> str:
    letters = f"non_alpha_words_ratio > {limits.max_non_alpha_words_ratio}::double" if limits.alpha_rule == "intent" else f"1 - non_alpha_words_ratio < {limits.max_non_alpha_words_ratio}::double"
    return f"""select doc_id, lang, source, w, case when n_words is null then 'blank'
    when n_words < {limits.min_doc_words} then 'too_few_words' when n_words > {limits.max_doc_words} then 'too_many_words'
    when mean_word_length < {limits.min_avg_word_length}::double then 'words_too_short' when mean_word_length > {limits.max_avg_word_length}::double then 'words_too_long'
    when symbol_word_ratio > {limits.max_symbol_word_ratio}::double then 'symbols'
    when len(r) > 0 and len([x for x in r if regexp_matches(x, '^[•●‣\\-*]')]) / len(r) > {limits.max_bullet_lines_ratio}::double then 'bullets'
    when len(r) > 0 and len([x for x in r if regexp_matches(x, '(\\.\\.\\.|…)$')]) / len(r) > {limits.max_ellipsis_lines_ratio}::double then 'ellipses'
    when {letters} then 'letters'
    when len(list_intersect({sql_words(sql_lower('text'))}, {_sql_stops()})) < {limits.min_stop_words} then 'stop_words' end drop_reason
    from (select d.doc_id, d.lang, d.source, d.text, {_LINES.replace('text', 'd.text')} r, {sql_words('d.text')} w, m.n_words, m.mean_word_length, m.symbol_word_ratio, m.non_alpha_words_ratio
          from documents d left join ({_METRICS}) m using (doc_id))"""


_REASONS = _sql_reasons(LIMITS)
#: The same with the customary rule for letters: at least so many words have one.
CUSTOMARY = quality.Thresholds(min_avg_word_length=3.0, max_avg_word_length=10.0, max_non_alpha_words_ratio=0.8, stop_words=STOPS, alpha_rule="gopher")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_by_source(spark, sf_dir)


@query(f"select lang, source, count(*) filter (drop_reason is null) kept, count(drop_reason) dropped, sum(len(w))::bigint words from ({_REASONS}) group by all")
def quality_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = documents(spark, sf_dir).select("lang", "source", text.word_count("text").alias("words"), quality.gopher_quality("text", LIMITS).alias("why"))
    return judged.groupBy("lang", "source").agg(F.count_if(F.col("why").isNull()).alias("kept"), F.count("why").alias("dropped"), F.sum("words").alias("words"))


@query(f"select doc_id, md5({sql_lower('text')}) lower_md5, md5({sql_upper('text')}) upper_md5, md5({sql_upper('left(text, 1)')} || {sql_lower('substr(text, 2)')}) title_md5 from documents")
def turkish_casing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("doc_id", F.md5(text.turkish_lower("text")).alias("lower_md5"), F.md5(text.turkish_upper("text")).alias("upper_md5"), F.md5(text.turkish_title("text")).alias("title_md5"))


@query(f"select doc_id, md5({_NORMAL}) text_md5 from documents")
def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("doc_id", F.md5(text.normalize("text")).alias("text_md5"))


@query(f"select doc_id, md5({sql_key('text')}) key_md5 from documents")
def dedup_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("doc_id", F.md5(text.dedup_key("text")).alias("key_md5"))


@query(f"select doc_id, md5(trim(regexp_replace(text, '{_WS}+', ' ', 'g'))) line_md5 from documents")
def one_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("doc_id", F.md5(text.collapse("text")).alias("line_md5"))


@query("select doc_id, round(('0x' || substr(md5(doc_id::varchar), 1, 13))::bigint / 4503599627370496.0::double, 12) unit from documents")
def stable_unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("doc_id", F.round(text.stable_unit("doc_id"), 12).alias("unit"))


@query("select page_id, coalesce(nullif(left(ltrim(regexp_replace(url, '[^A-Za-z0-9._-]+', '_', 'g'), '.'), 240), ''), 'file') filename from pages")
def safe_filenames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text.safe_filename("url").alias("filename"))


@query(f"select doc_id, n_words::bigint n_words, round(mean_word_length, 9) mean_word_length, round(symbol_word_ratio, 9) symbol_word_ratio, round(non_alpha_words_ratio, 9) non_alpha_words_ratio from ({_METRICS})")
def doc_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = documents(spark, sf_dir).where(F.col("text").rlike(text.WORD)).select("doc_id", quality.metrics("text").alias("m"))
    return m.select("doc_id", "m.n_words", *[F.round(f"m.{c}", 9).alias(c) for c in calibrate.METRICS[1:]])


@query(f"select doc_id, drop_reason from ({_REASONS})")
def gopher_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("doc_id", quality.gopher_quality("text", LIMITS).alias("drop_reason"))


@query(f"select doc_id, drop_reason from ({_sql_reasons(CUSTOMARY)})")
def gopher_quality_customary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("doc_id", quality.gopher_quality("text", CUSTOMARY).alias("drop_reason"))


_ENDS = f"""select doc_id, case when len(r) = 0 then 'blank' when len([x for x in r if regexp_matches(x, '[.!?…。！？"''”]$')]) / len(r) <= 0.12::double then 'line_ends'
    when len([x for x in r if length(x) < 30]) / len(r) >= 0.67::double then 'short_lines'
    when (list_sum([length(x) for x in r]) - list_sum([length(x) for x in list_distinct(r)])) / list_sum([length(x) for x in r]) >= 0.1::double then 'repeated_lines' end drop_reason
    from (select doc_id, {_LINES} r from documents)"""


@query(_ENDS)
def fineweb_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("doc_id", quality.fineweb_quality("text").alias("drop_reason"))


@query(f"""select doc_id, round((len(a) - len(list_distinct(a))) / len(a), 9) dup_line_frac, round((list_sum([length(x) for x in a]) - list_sum([length(x) for x in list_distinct(a)])) / length(text), 9) dup_line_char_frac,
    round((len(b) - len(list_distinct(b))) / len(b), 9) dup_para_frac, round((list_sum([length(x) for x in b]) - list_sum([length(x) for x in list_distinct(b)])) / length(text), 9) dup_para_char_frac
    from (select doc_id, text, string_split_regex({sql_strip('text')}, '\\n+') a, string_split_regex({sql_strip('text')}, '\\n{{2,}}') b from documents where length(text) > 0)""")
def repeated_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = documents(spark, sf_dir).where(F.length("text") > 0).select("doc_id", quality.repeated_parts("text").alias("p"))
    return p.select("doc_id", *[F.round(f"p.{c}", 9).alias(c) for c in ("dup_line_frac", "dup_line_char_frac", "dup_para_frac", "dup_para_char_frac")])


def _sql_top(n: int) -> str:
    gram = " || ' ' || ".join(f"w[i + {k}]" for k in range(n))
    return f"""select doc_id, max_by(c * length(g), struct_pack(c := c, l := length(g))) chars from (select doc_id, g, count(*) c
        from (select doc_id, unnest([{gram} for i in range(1, len(w) - {n - 2})]) g from docs) group by all having count(*) > 1) group by all"""


@query(f"""with docs as (select doc_id, text, {sql_words('text')} w from documents)
    select d.doc_id, round(coalesce(a.chars, 0) / greatest(length(text), 1), 9) top_2, round(coalesce(b.chars, 0) / greatest(length(text), 1), 9) top_3, round(coalesce(c.chars, 0) / greatest(length(text), 1), 9) top_4
    from docs d left join ({_sql_top(2)}) a using (doc_id) left join ({_sql_top(3)}) b using (doc_id) left join ({_sql_top(4)}) c using (doc_id)""")
def top_grams(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = documents(spark, sf_dir).select("doc_id", quality.repeated_grams("text").alias("g"))
    return g.select("doc_id", *[F.round(F.get("g", F.lit(i)), 9).alias(f"top_{n}") for i, (n, _) in enumerate(quality.TOP_GRAMS)])


def _sql_repeated(source: str) -> str:
    """``(doc_id, n, repeated)``: characters of n-grams that were read before. Places of n-grams that occur earlier are folded
    from the left: one is met again if an earlier one of it does not lie within what was left out behind an n-gram met again."""
    state = "struct_pack(at := {}, total := {}, hits := {}, i := 0::bigint, occ := []::bigint[], chars := 0::bigint)"
    free = "len(list_filter(a.hits, lambda s: s < {0} and {0} < s + n)) = 0"
    again = state.format("x.i + n", "a.total + x.chars", "list_append(a.hits, x.i)")
    return f"""select doc_id, n, list_reduce(list_prepend({state.format("0::bigint", "0::bigint", "[]::bigint[]")}, f), lambda a, x: case when x.i < a.at then a when {free.format("x.occ[1]")} then {again}
        when len(list_filter(x.occ, lambda p: {free.format("p")})) > 0 then {again} else {state.format("x.i + 1", "a.total", "a.hits")} end).total repeated
        from (select doc_id, n, list(struct_pack(at := 0::bigint, total := 0::bigint, hits := []::bigint[], i := i, occ := occ, chars := chars) order by i) f
          from (select doc_id, n, i, length(gram) - n + 1 chars, list(i) over (partition by doc_id, n, gram order by i rows between unbounded preceding and 1 preceding) occ
            from (select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') gram from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) i from {source}, (select unnest({[n for n, _ in quality.DUP_GRAMS]}) n))))
          where len(occ) > 0 group by all)"""


def _sql_repetition(source: str) -> str:
    """``(doc_id, drop_reason)`` of a table ``(doc_id, text, w)``."""
    share = lambda x, y: f"(list_sum([length(x) for x in {x}]) - list_sum([length(x) for x in list_distinct({x})])) / {y}"
    once = lambda x: f"(len({x}) - len(list_distinct({x}))) / len({x})"
    parts = [once("a"), share("a", "length(text)"), once("b"), share("b", "length(text)")]
    names = ("dup_line_frac", "dup_line_char_frac", "dup_para_frac", "dup_para_char_frac")
    rules = [f"when {x} > {limit}::double then '{name}'" for name, x, limit in zip(names, parts, quality.DUP_PARTS, strict=True)]
    rules += [f"when coalesce(t{n}.chars, 0) / greatest(length(text), 1) > {limit}::double then 'top_{n}_gram'" for n, limit in quality.TOP_GRAMS]
    rules += [f"when coalesce(m[{n}], 0) / greatest(length(text), 1) > {limit}::double then 'duplicated_{n}_gram'" for n, limit in quality.DUP_GRAMS]
    joins = " ".join(f"left join ({_sql_top(n).replace('from docs)', f'from {source})')}) t{n} using (doc_id)" for n, _ in quality.TOP_GRAMS)
    return f"""select doc_id, case when coalesce({sql_strip('text')}, '') = '' then 'blank' {' '.join(rules)} end drop_reason
        from (select doc_id, text, string_split_regex({sql_strip('text')}, '\\n+') a, string_split_regex({sql_strip('text')}, '\\n{{2,}}') b from {source}) {joins}
        left join (select doc_id, map(list(n), list(repeated)) m from ({_sql_repeated(source)}) group by doc_id) using (doc_id)"""


@query(f"with docs as (select doc_id, text, {sql_words('text')} w from documents) {_sql_repetition('docs')}")
def gopher_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("doc_id", quality.gopher_repetition("text").alias("drop_reason"))


def _sql_profile(k: str) -> str:
    return f"len([x for x in w if x in ({', '.join(repr(p) for p in quality.PROFILES[k].split())})]) / greatest(len(w), 1)"


@query(f"""select doc_id, {', '.join(f'round({_sql_profile(k)}, 9) {k}' for k in quality.PROFILES)} from (select doc_id, [regexp_replace(x, '\\P{{L}}+', '', 'g') for x in {sql_words('lower(text)')}] w from documents)""")
def language_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = documents(spark, sf_dir).select("doc_id", quality.language_scores("text").alias("s"))
    return s.select("doc_id", *[F.round(f"s.{k}", 9).alias(k) for k in quality.PROFILES])


def _sql_guess(wanted: tuple[str, ...]) -> str:
    return f"""select doc_id, lang, coalesce(case when t > 0 then greatest(0.0, {', '.join(wanted)}) / t >= 0.65::double end, false) guess from (select *, 0.0::double + {' + '.join(quality.PROFILES)} t
    from (select doc_id, lang, {', '.join(f'{_sql_profile(k)} {k}' for k in quality.PROFILES)} from (select doc_id, lang, [regexp_replace(x, '\\P{{L}}+', '', 'g') for x in {sql_words('lower(text)')}] w from documents)))"""


@query(f"select doc_id, guess, coalesce(case when doc_id % 2 = 0 then lang in ('en', 'fr') end, guess) kept from ({_sql_guess(('en', 'fr'))})")
def language_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether texts are English or French, by their words alone, and with the language noted of every other document."""
    known = F.when(F.col("doc_id") % 2 == 0, F.col("lang"))
    return documents(spark, sf_dir).select("doc_id", quality.language_gate("text", ("en", "fr")).alias("guess"), quality.language_gate("text", ("en", "fr"), known=known).alias("kept"))


_FREQ = f"select w word, count(*) freq from (select unnest({sql_words(sql_lower('text'))}) w from documents) where regexp_full_match(w, '\\p{{L}}+') group by w"


@query(f"select word, freq from ({_FREQ}) order by freq desc, word limit 175")
def calibrate_stopwords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calibrate.stop_words(documents(spark, sf_dir))


def _sql_band(name: str, strategy: str) -> tuple[str, str]:
    x = f"{name}::double"
    if strategy == "meanstd":
        return f"greatest(avg({x}) - 3 * stddev_pop({x}), min({x}))", f"least(avg({x}) + 3 * stddev_pop({x}), max({x}))"
    p = 0.1 if strategy == "10tail" else 0.005
    return f"quantile_cont({x}, {p})", f"quantile_cont({x}, {1 - p})"


def _sql_limits(strategy: str) -> str:
    n, w, s, a = (_sql_band(m, strategy) for m in calibrate.METRICS)
    return f"""select greatest(10, round_even({n[0]}, 0)::bigint) min_doc_words, least(greatest(round_even({n[1]}, 0)::bigint, 100000), 1000000) max_doc_words, round({w[0]}, 9) min_avg_word_length,
        round({w[1]}, 9) max_avg_word_length, round(greatest({s[1]}, 0.05), 9) max_symbol_word_ratio, round(greatest({a[1]}, 0.2), 9) max_non_alpha_words_ratio from ({_METRICS})"""


def _limits(spark: SparkSession, sf_dir: str, strategy: str) -> DataFrame:
    found = calibrate.limits(documents(spark, sf_dir), strategy)
    return found.select("min_doc_words", "max_doc_words", *[F.round(c, 9).alias(c) for c in found.columns[2:]])


@query(_sql_limits("quantile"))
def calibrate_quantile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _limits(spark, sf_dir, "quantile")


@query(_sql_limits("10tail"))
def calibrate_10tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _limits(spark, sf_dir, "10tail")


@query(_sql_limits("meanstd"))
def calibrate_meanstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _limits(spark, sf_dir, "meanstd")


@query(f"""select metric, count(*) n_docs, round(avg(x), 9) mean, {', '.join(f'round(quantile_cont(x, {p}), 9) p{round(100 * p):02d}' for p in calibrate.QUANTILES)} from (
    {' union all '.join(f"select '{m}' metric, {m}::double x from ({_METRICS})" for m in calibrate.METRICS)}) group by metric""")
def calibration_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = calibrate.report(documents(spark, sf_dir))
    return found.select("metric", "n_docs", *[F.round(c, 9).alias(c) for c in found.columns[2:]])


_BYTE = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"


def _sql_addresses(x: str) -> str:
    # the mark of an IPv6 address is two colons beside hexadecimal digits
    email = f"regexp_replace({x}, '\\b[A-Za-z0-9._%+-]+@(?:[A-Za-z0-9-]+\\.)+[A-Za-z]{{2,}}\\b', '{pii.EMAIL}', 'g')"
    six = f"regexp_replace({email}, '(^|[^0-9A-Za-z:.])(?:{'|'.join(pii._IP6_FORMS)})($|[^0-9A-Za-z:.]|\\.[^0-9]|\\.$)', '\\1{pii.IP}\\2', 'g')"
    return f"regexp_replace({six}, '\\b{_BYTE}(?:\\.{_BYTE}){{3}}\\b', '{pii.IP}', 'g')"


_ADDRESSED = "concat('net 2001:db8::', cast(doc_id % 9999 as string), ' and 1:2:3:4:5:6:7:8, ::1; at 10:20:30 x::y. ', text)"


@query(f"select doc_id, md5({_sql_addresses('text')}) text_md5 from (select doc_id, {_ADDRESSED} text from documents)")
def redact_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = documents(spark, sf_dir).select("doc_id", F.expr(_ADDRESSED).alias("text"))
    return made.select("doc_id", F.md5(pii.redact_addresses("text")).alias("text_md5"))


_ELEVEN = "(10000000000 + doc_id * 829348951 % 89999999999)"


@query(f"""select doc_id, v value, v[1] <> '0' and ((7 * (v[1]::int + v[3]::int + v[5]::int + v[7]::int + v[9]::int) - (v[2]::int + v[4]::int + v[6]::int + v[8]::int)) % 10 + 10) % 10 = v[10]::int
    and list_sum([c::int for c in string_split(left(v, 10), '')]) % 10 = v[11]::int valid
    from (select doc_id, unnest(regexp_extract_all('no ' || {_ELEVEN} || '; 7' || {_ELEVEN} || ' ' || text, '[0-9]+')) v from documents) where length(v) = 11""")
def national_id_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of eleven digits in texts, and in front of each text a number made of its id: about one in a hundred is right."""
    made = F.expr(f"concat('no ', {_ELEVEN}, '; 7', {_ELEVEN}, ' ', text)")
    found = documents(spark, sf_dir).select("doc_id", F.explode(F.regexp_extract_all(made, F.lit(pii.ID_PATTERN), F.lit(0))).alias("value"))
    return found.select("doc_id", "value", pii.is_national_id("value").alias("valid"))


@query("""select doc_id, v value, list_reduce([0, *[ascii(c) - 48 for c in string_split(d, '')]], lambda a, c: (a * 10 + c) % 97) = 1 valid from (select *, regexp_replace(substr(v, 5) || '2927' || substr(v, 3, 2), '[^0-9]', '', 'g') d
    from (select doc_id, 'TR' || lpad((doc_id * 7919 % 97)::varchar, 2, '0') || lpad((doc_id * 104729)::varchar, 22, '0') v from documents))""".replace("[0, *[ascii(c) - 48 for c in string_split(d, '')]]", "list_concat([0], [ascii(c) - 48 for c in string_split(d, '')])"))
def iban_mod97(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account numbers made of document ids: about one in 97 is right."""
    made = F.concat(F.lit("TR"), F.lpad((F.col("doc_id") * 7919 % 97).cast("string"), 2, "0"), F.lpad((F.col("doc_id") * 104729).cast("string"), 22, "0"))
    return documents(spark, sf_dir).select("doc_id", made.alias("value")).withColumn("valid", pii.is_iban("value"))


def _sql_id(v: str) -> str:
    digit = lambda i: f"try_cast({v}[{i}] as int)"
    odd, even = (" + ".join(digit(i) for i in places) for places in ((1, 3, 5, 7, 9), (2, 4, 6, 8)))
    return f"coalesce(regexp_full_match({v}, '[1-9][0-9]{{10}}') and ((7 * ({odd}) - ({even})) % 10 + 10) % 10 = {digit(10)} and ({odd} + {even} + {digit(10)}) % 10 = {digit(11)}, false)"


def _sql_iban(v: str) -> str:
    v = f"upper(regexp_replace({v}, '[ -]', '', 'g'))"
    steps = f"[case when c between '0' and '9' then ascii(c) - 48 else ascii(c) - 55 end for c in string_split(substr({v}, 5) || left({v}, 4), '')]"
    return f"list_reduce({steps}, lambda a, c: (a * case when c < 10 then 10 else 100 end + c) % 97, 0) = 1"


def _sql_redact(source: str) -> str:
    """``(doc_id, text, iban, phone, tc_kimlik)`` of ``(doc_id, text)``; what stands around a match is matched and put back."""
    bare = lambda pattern: pattern.replace("(?i)", "").replace(pii._NO_DIGIT_BEFORE, "").replace(pii._NO_WORD_BEFORE, "").replace(pii._NO_WORD_AFTER, "")
    no_word = r"[^\p{L}\p{N}_]"
    found = f"list_filter(regexp_extract_all(text, '(?i)(?:^|[^0-9])({bare(pii.IBAN_PATTERN)})(?:$|{no_word})', 1), lambda v: {_sql_iban('v')})"
    phones = lambda x: f"regexp_replace({x}, '(^|{no_word}){bare(pii.PHONE_PATTERN)}($|{no_word})', '\\1{pii.PLACEHOLDERS['phone']}\\2', 'g')"
    ids = f"[case when {_sql_id('x')} then '{pii.PLACEHOLDERS['tc_kimlik']}' else x end for x in regexp_extract_all(text, '[0-9]+|[^0-9]+')]"
    count = lambda kind, x: f"len(regexp_extract_all({x}, '{pii.PLACEHOLDERS[kind]}'))"
    one = f"select doc_id, text before, {found} hits from ({source})"
    two = f"select doc_id, before, list_reduce(hits, lambda a, v: replace(a, v, '{pii.PLACEHOLDERS['iban']}'), before) text, len(hits) iban from ({one})"
    # twice, as what stands between two may be one character
    three = f"select doc_id, before, {phones(phones('text'))} text, iban from ({two})"
    return f"select doc_id, t text, iban, {count('phone', 't')} - {count('phone', 'before')} phone, {count('tc_kimlik', 't')} - {count('tc_kimlik', 'before')} tc_kimlik from (select *, array_to_string({ids}, '') t from ({three}))"


#: Personal data made of document ids, in front of each text: account numbers, phones and national ids.
_PERSONAL = f"""concat('IBAN TR', lpad(cast(doc_id * 7919 % 97 as string), 2, '0'), lpad(cast(doc_id * 104729 as string), 22, '0'), '; 0532 ', cast(100 + doc_id % 900 as string), ' 45 67, tel. +90 (312) 555', cast(1000 + doc_id % 9000 as string), '; no ', {_ELEVEN}, '. ', text)"""


@query(f"""select doc_id, md5(text) text_md5, '{{' || concat_ws(',', case when iban > 0 then '"iban":' || iban end, case when phone > 0 then '"phone":' || phone end, case when tc_kimlik > 0 then '"tc_kimlik":' || tc_kimlik end) || '}}' pii
    from ({_sql_redact(f"select doc_id, {_NORMAL} text from (select doc_id, {_PERSONAL} text from documents)")})""")
def redact_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = documents(spark, sf_dir).select("doc_id", F.expr(_PERSONAL).alias("text"))
    return pii.redact(made.select("doc_id", text.normalize("text").alias("text"))).select("doc_id", F.md5("text").alias("text_md5"), F.to_json("pii").alias("pii"))


@query(f"select doc_id, len({sql_words('text')})::bigint n_tokens from documents")
def token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(documents(spark, sf_dir), id_col="doc_id").select("doc_id", F.col("token_count").alias("n_tokens"))


@query(f"""select count(*) documents, count(t) counted_docs, sum(t)::bigint tokens, sum(t) / 0.25::double estimated_tokens from (select case when ('0x' || substr(md5(doc_id::varchar), 1, 13))::bigint / 4503599627370496.0::double < 0.25
    then len({sql_words('text')}) end t from documents)""")
def token_sample_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_estimate(tokens.count_tokens(documents(spark, sf_dir), rate=0.25, id_col="doc_id"), 0.25)


@query(f"""select role, count(*) n_texts, sum(w)::bigint words, sum(t)::bigint tokens, round(sum(t) / sum(w), 9) tokens_per_word from (select role, len({sql_words('text')}) w, len(regexp_extract_all(text, '[\\p{{L}}]+|[0-9]|[^\\p{{L}}0-9\\s]')) t from conversations) group by role""")
def fertility_by_role(spark: SparkSession, sf_dir: str) -> DataFrame:
    count = lambda c: F.regexp_count(c, F.lit(r"[\p{L}]+|[0-9]|[^\p{L}0-9\s]")).cast("long")
    found = tokens.fertility(table(spark, sf_dir, "conversations"), count, group=("role",))
    return found.withColumn("tokens_per_word", F.round("tokens_per_word", 9))


@query(f"select min(doc_id) keep_id, count(*) copies, md5({sql_key('text')}) \"key\" from documents group by md5({sql_key('text')})")
def exact_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.exact_groups(documents(spark, sf_dir), "doc_id")


def _sql_hashes(source: str = "documents") -> str:
    plain = f"regexp_replace({sql_key('text')}, '[^\\p{{L}}\\p{{N}}\\s]+', ' ', 'g')"
    return f"""select doc_id, [('0x' || substr(md5(s), 1, 8))::bigint >> 1 for s in list_distinct([array_to_string(w[i:i + 4], ' ') for i in range(1, greatest(len(w) - 4, 1) + 1)])] h
        from (select doc_id, {sql_words(plain)} w from {source}) where len(w) > 0"""


def _sql_bands(source: str = "documents") -> str:
    mins = ", ".join(f"list_min([(x * {a} + {b}) % {dedup.PRIME} for x in h])" for a, b in dedup.permutations())
    return f"select doc_id id, b::int band, md5(array_to_string([x::varchar for x in s[b * 8 + 1:b * 8 + 8]], ',')) \"key\" from (select doc_id, [{mins}] s from ({_sql_hashes(source)})), range(14) r(b)"


@query(_sql_bands())
def minhash_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.bands(documents(spark, sf_dir), "doc_id")


@query(f"""with recursive b as materialized ({_sql_bands()}), l as materialized (select distinct m a, id b from b join (select band, "key", min(id) m from b group by all having count(*) > 1) using (band, "key") where m <> id),
    pairs as materialized (select a, b from l union select b, a from l), reach as (select distinct a id, a r from pairs union select reach.id, pairs.b from reach join pairs on reach.r = pairs.a)
    select id, min(r) keep_id, count(*) cluster_size from reach group by id""")
def near_dup_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.near_groups(documents(spark, sf_dir), "doc_id")


@query(f"""with u as (select 'doc-' || doc_id id, text from documents union all select 'item-' || item_id, text from benchmark) select min(id) keep_id, count(*) copies, md5({sql_key('text')}) "key" from u group by md5({sql_key('text')})""")
def cross_source_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select(F.concat(F.lit("doc-"), "doc_id").alias("id"), "text")
    items = table(spark, sf_dir, "benchmark").select(F.concat(F.lit("item-"), "item_id").alias("id"), "text")
    return dedup.exact_groups(docs.unionByName(items))


SOURCES = [blend.Source(k, w) for k, w in (("en", 5.0), ("fr", 2.0), ("es", 2.0), ("de", 1.0))]
BUDGET = 100_000


def _counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select(F.col("doc_id").alias("id"), F.col("lang").alias("source"), text.word_count("text").alias("tokens"))


_TARGETS = "(values " + ", ".join(f"('{k}', {v})" for k, v in blend.targets(SOURCES, BUDGET).items()) + ") t(source, target_tokens)"
_CHOSEN = f"""select id, source, tokens, before::bigint before from (select *, coalesce(sum(tokens) over (partition by source order by md5('7:' || source || ':' || id), id rows between unbounded preceding and 1 preceding), 0) before
    from (select doc_id id, lang source, len({sql_words('text')})::bigint tokens from documents)) join {_TARGETS} using (source) where before < target_tokens"""


@query(_CHOSEN)
def blend_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blend.select(_counted(spark, sf_dir), SOURCES, BUDGET, seed=7)


@query(f"""with rows_ as (select t.source, target_tokens::bigint target_tokens, coalesce(a.n, 0)::bigint available_tokens, coalesce(c.n, 0)::bigint achieved_tokens, coalesce(c.docs, 0)::bigint docs, greatest(0, target_tokens - coalesce(c.n, 0))::bigint shortfall_tokens
    from {_TARGETS} left join (select lang source, sum(len({sql_words('text')})) n from documents group by lang) a using (source) left join (select source, sum(tokens) n, count(*) docs from ({_CHOSEN}) group by source) c using (source))
    select * from rows_ union all select null, {BUDGET}, sum(available_tokens)::bigint, sum(achieved_tokens)::bigint, sum(docs)::bigint, sum(shortfall_tokens)::bigint from rows_""")
def blend_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = _counted(spark, sf_dir)
    return blend.manifest(counted, blend.select(counted, SOURCES, BUDGET, seed=7), SOURCES, BUDGET)


@query(f"""select id, md5(line) line_md5, rank <= greatest(1, round_even(0.05 * n, 0)) evaluation from (select *, row_number() over (order by md5('3:' || id || ':' || line)) rank, count(*) over () n
    from (select (doc_id // 2)::varchar id, arg_min(trim(regexp_replace(text, '{_WS}+', ' ', 'g')), doc_id) line from documents group by 1) where length(line) >= 20)""")
def export_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each id is that of two documents; the first of them is taken."""
    rows = documents(spark, sf_dir).select(F.expr("doc_id div 2").alias("id"), "text", "doc_id")
    train, held = blend.export_split(rows, 0.05, 3, min_chars=20, order_col="doc_id")
    return train.withColumn("evaluation", F.lit(False)).unionByName(held.withColumn("evaluation", F.lit(True))).select("id", F.md5("text").alias("line_md5"), "evaluation")


_HOST = "lower(regexp_extract(url, '(?i)^https?://([^/?#:@]+)', 1))"


@query(f"select {_HOST} host, count(*) pages from pages group by 1 having count(*) >= 2 order by pages desc, host limit 20")
def host_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hosts.host_rank(table(spark, sf_dir, "pages").select(text.url_host("url").alias("url_host_name")), min_pages=2, limit=20)


def _ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(text.url_host("url").alias("host"), F.col("page_id").alias("rank"))


@query(f"select regexp_replace({_HOST}, '^www\\.', '') as \"domain\", min(page_id) rank from pages group by 1")
def allowed_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hosts.allowed_domains(_ranked(spark, sf_dir))


@query(f"select 'https://' || {_HOST} || '/robots.txt' robots_url, min(page_id) rank from pages group by 1")
def robots_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hosts.robots_urls(_ranked(spark, sf_dir))


@query(f"select page_id, coalesce(not regexp_matches({_HOST}, '^(localhost|127\\.0\\.0\\.1|169\\.254\\..*|10\\..*|192\\.168\\..*|172\\.(1[6-9]|2[0-9]|3[01])\\..*)$') and {_HOST} <> '', false) safe from pages")
def safe_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text.is_safe_url("url").alias("safe"))


def _sql_html() -> str:
    silent = "|".join(rf"<{t}\b[^>]*>.*?</{t}\s*>" for t in text._SILENT.split("|"))
    out = f"regexp_replace(html, '(?is)<!--.*?-->|{silent}', ' ', 'g')"
    out = f"regexp_replace(regexp_replace({out}, '(?is)</?(?:{text._LINE_TAGS})\\b[^>]*>', chr(10), 'g'), '(?s)<[^>]*>', '', 'g')"
    for entity, plain in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&amp;", "&")):
        out = f"replace({out}, '{entity}', '{plain}')"
    out = f"regexp_replace(regexp_replace({out}, '[ \\t\\r\\f\\x0b]+', ' ', 'g'), ' ?\\n[ \\n]*', chr(10), 'g')"
    return f"regexp_replace({out}, '^[ \\n]+|[ \\n]+$', '', 'g')"


@query(f"select page_id, length(t)::int n_chars, md5(t) text_md5 from (select page_id, {_sql_html()} t from pages)")
def html_text_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text.html_text("html").alias("t")).select("page_id", F.length("t").alias("n_chars"), F.md5("t").alias("text_md5"))


@query(f"select url id, md5(t) text_md5, 'crawl' source from (select url, {_sql_html()} t from pages) where length(t) >= 200")
def crawl_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.crawl_documents(table(spark, sf_dir, "pages")).select("id", F.md5("text").alias("text_md5"), F.col("metadata")["source"].alias("source"))


@query(f"select page_id, nullif(trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '{_WS}+', ' ', 'g')), '') title from pages")
def page_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text.html_title("html").alias("title"))


_LINKS = """select page_id page, (generate_subscripts(l, 1) - 1)::int pos, unnest(l) href from (select page_id, regexp_extract_all(html, '(?i)<a\\b[^>]*?\\bhref\\s*=\\s*["'']([^"'']*)["'']', 1) l from pages)"""


@query(f"select page, pos, href from ({_LINKS}) where href <> '' and not regexp_matches(href, '(?i)^(#|mailto:|javascript:)')")
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hosts.page_links(table(spark, sf_dir, "pages")).select("page", "pos", "href")


@query(f"select page, min(pos) pos, regexp_extract(url, '^https?://[^/]+') || href link from ({_LINKS}) join pages on page = page_id where regexp_matches(href, '^/[^/]') and regexp_extract(url, '^https?://[^/]+') || href <> url and contains(lower(regexp_extract(url, '^https?://[^/]+') || href), '/t') group by all")
def archive_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links within a page's host whose address holds /t."""
    return hosts.archive_links(table(spark, sf_dir, "pages"), archive="/t").select("page", "pos", "link")


@query("select d::date as \"day\", 'https://gazette.example/eskiler/' || strftime(d, '%Y/%m/%Y%m%d') || '.htm' url from range(date '2023-12-28', date '2024-03-02', interval 1 day) t(d)")
def gazette_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.gazette_days(spark, date(2023, 12, 28), date(2024, 3, 1), "https://gazette.example")


@query(f"select w word, count(*) freq from (select unnest({sql_words(sql_lower('text'))}) w from documents) group by w order by freq desc, word limit 500")
def word_vocab_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.word_table(documents(spark, sf_dir), top=500)


def _sql_merge(source: str) -> str:
    """The pair that the next merge takes, over rows (symbols, freq)."""
    return f"select s[i] a, s[i + 1] b, sum(freq)::bigint freq from (select s, freq, unnest(range(1, len(s))) i from {source}) group by all order by freq desc, a, b limit 1"


def _sql_merges(rounds: int) -> str:
    parts = [f"t0 as materialized (select string_split(w, '') s, count(*) freq from (select unnest({sql_words(sql_lower('text'))}) w from documents) group by w)"]
    for k in range(rounds):
        parts.append(f"p{k} as materialized ({_sql_merge(f't{k}')})")
        step = "case when len(o) > 0 and x = p.b and o[len(o)] = p.a then list_append(o[1:len(o) - 1], o[len(o)] || x) else list_append(o, x) end"
        parts.append(f"t{k + 1} as materialized (select list_reduce(list_prepend([]::varchar[], [[y] for y in s]), lambda o, z: {step.replace('x', 'z[1]').replace('maz[1]', 'max')}) s, t{k}.freq freq from t{k}, p{k} p)")
    return f"with {', '.join(parts)} " + " union all ".join(f"select {k} round, a, b, freq from p{k}" for k in range(rounds))


@query(_sql_merges(3))
def bpe_first_merges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first merges over the characters of all words, counted by Spark."""
    words = written(tokens.word_table(documents(spark, sf_dir)).select(F.filter(F.split("word", ""), lambda c: c != "").alias("symbols"), "freq"), "words")
    out = None
    for k in range(3):
        pair = tokens.best_pair(words)
        found = pair.first()
        row = pair.select(F.lit(k).alias("round"), "a", "b", "freq")
        out = row if out is None else out.unionAll(row)
        if found is None:
            break
        words = written(tokens.merge_pair(words, found.a, found.b), "merged")
    return out


@query(f"select doc_id id, md5(array_to_string(w, ' ')) text_md5 from (select doc_id, {sql_words('text')} w from documents) where len(w) > 0")
def segment_join_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segmentation by an analyser that leaves words as they are."""
    return tokens.segment(documents(spark, sf_dir), lambda w: [w], "doc_id").select("id", F.md5("text").alias("text_md5"))


@query(f"""select count(*) lines_in, count(*) filter (len(w) > 0) lines_out, count(*) filter (len(w) = 0) lines_dropped, sum(len(w))::bigint words, (select count(distinct x) from (select unnest({sql_words('text')}) x from documents)) unique_words,
    (select count(distinct x) from (select unnest({sql_words('text')}) x from documents) where length(x) > 70) passthrough from (select {sql_words('text')} w from documents)""")
def segmentation_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.segmentation_stats(documents(spark, sf_dir))


@query(f"select doc_id, md5(array_to_string({sql_words('text')}, ' ')) decoded_md5 from documents")
def tokenizer_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts encoded to ids by a tokenizer built on them, and decoded again: what comes back is the text, spaces collapsed."""
    docs = documents(spark, sf_dir)
    made = tokens.build_tokenizer(docs, tokens.suffixes, vocabulary=4000, n_merges=100, top=2000)
    ids = docs.select("doc_id", tokens.encode_column(made)("text").alias("ids"))
    return ids.select("doc_id", F.md5(tokens.decode_column(made)("ids")).alias("decoded_md5"))


@query(f"select doc_id, 'wiki-' || doc_id id, source title, md5(text) text_md5 from documents order by doc_id limit 50")
def encyclopedia_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents(spark, sf_dir).orderBy("doc_id").select(F.col("doc_id").alias("id"), F.col("source").alias("title"), "text", F.lit(None).cast("string").alias("url"))
    made = readers.encyclopedia(rows, limit=50)
    return made.select(F.regexp_extract("id", "[0-9]+", 0).cast("long").alias("doc_id"), "id", F.col("metadata")["title"].alias("title"), F.md5("text").alias("text_md5"))


@query("select 'mevzuat-' || doc_id id, md5(coalesce(nullif(a, ''), b)) text_md5 from (select doc_id, case when doc_id % 3 = 0 then '' when doc_id % 3 = 1 then text end a, case when doc_id % 2 = 0 then text end b from documents) where coalesce(nullif(a, ''), b) <> ''")
def legislation_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = documents(spark, sf_dir).select(F.col("doc_id").alias("id"), F.when(F.col("doc_id") % 3 == 0, "").when(F.col("doc_id") % 3 == 1, F.col("text")).alias("text"), F.when(F.col("doc_id") % 2 == 0, F.col("text")).alias("content"))
    return readers.legislation(made).select("id", F.md5("text").alias("text_md5"))


CLEANING = Cleaning(languages=LANGUAGES, language_col="lang", limits=LIMITS)


_EARLY = f"""select doc_id, d.text, coalesce(case when not coalesce(lang in {LANGUAGES}, guess) then 'language' end, 'quality:' || q.drop_reason, 'lines:' || l.drop_reason) drop_reason
    from documents d join ({_sql_guess(LANGUAGES)}) g using (doc_id, lang) join ({_REASONS}) q using (doc_id) join ({_ENDS}) l using (doc_id)"""
_DROPPED = f"""early as materialized ({_EARLY}), docs as materialized (select doc_id, text, {sql_words('text')} w from early where drop_reason is null), again as materialized ({_sql_repetition('docs')}),
    judged as materialized (select doc_id, e.text, coalesce(e.drop_reason, 'repetition:' || a.drop_reason) drop_reason from early e left join again a using (doc_id))"""


@query(f"with {_DROPPED} select doc_id, drop_reason from judged")
def drop_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reasons(documents(spark, sf_dir), CLEANING).select("doc_id", "drop_reason")


_PREPARED = f"select doc_id, {_sql_addresses('text')} text from ({_sql_redact(f'select doc_id, {_NORMAL} text from judged where drop_reason is null')})"


@query(f"""with recursive {_DROPPED}, ready as materialized ({_PREPARED}), apart as materialized (select doc_id, text from ready where doc_id in (select min(doc_id) from ready group by md5({sql_key('text')}))),
    b as materialized ({_sql_bands('apart')}), l as materialized (select distinct m a, id b from b join (select band, "key", min(id) m from b group by all having count(*) > 1) using (band, "key") where m <> id),
    pairs as materialized (select a, b from l union select b, a from l), reach as (select distinct a id, a r from pairs union select reach.id, pairs.b from reach join pairs on reach.r = pairs.a),
    kept as (select count(*) n from apart where doc_id not in (select id from reach group by id having min(r) < id))
    select 'kept' outcome, n documents from kept where n > 0 union all select 'duplicate', (select count(*) from ready) - n from kept where (select count(*) from ready) > n union all select drop_reason, count(*) from judged where drop_reason is not null group by drop_reason""")
def clean_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole cleaning run: how many documents are kept, duplicates, or rejected for what."""
    return clean(documents(spark, sf_dir), CLEANING, "doc_id").summary()


@query("select time_bucket(interval 1 hour, ts) as \"start\", event_type, count(*) n, round(sum(value), 6) total from events group by all")
def event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_counts(table(spark, sf_dir, "events")).withColumn("total", F.round("total", 6))
