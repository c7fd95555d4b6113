"""Registered queries of this package, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe_coding import decode, encode
from .decontamination import contaminated
from .html_density import extract_text
from .importance import resample
from .language_id import fit as fit_languages
from .language_id import predict as predict_languages
from .line_dedup import line_report
from .mixing import mix_sizes
from .near_dedup import near_duplicates
from .quality_rules import quality
from .ranked_search import search
from .suffix_dedup import remove_repeats
from .token_counts import token_counts
from .toxicity import fit as fit_toxicity
from .toxicity import score as score_toxicity

#: The tokenizer file of op6 and the length that its query reports against.
TOKENIZER, TOKEN_LIMIT = "word_bpe_49k.json", 2048
#: The ranks of op11.
RANKS = "byte_bpe_50k.tiktoken"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(_table(spark, sf_dir, "documents"))


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_table(spark, sf_dir, "documents"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(_table(spark, sf_dir, "pages"))


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), width=2)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(_table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    counts = token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return score_toxicity(docs, fit_toxicity(docs, _table(spark, sf_dir, "labels")))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return predict_languages(docs, fit_languages(docs))


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sizes(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = public_tokenizers.path(RANKS)
    coded = decode(encode(_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN), ranks)
    text = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(text.cast("binary"), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_line_dedup, op2_suffix_array_dedup, op3_html_extraction, op4_minhash_near_dedup,
        op5_quality_rules, op6_token_counts, op7_toxicity, op8_language_id, op9_benchmark_decontamination, op10_mix_sources,
        op11_byte_bpe, op12_importance_resampling, op13_ranked_search)
}

#: A-Z to a-z and nothing else, then the words, as the operators take them.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

_NEAR = f"""
with recursive words as (
  select doc_id, {_WORDS.format(_LOWER)} w from documents
), sets as (
  select distinct doc_id, s from (
    select doc_id, unnest(case when len(w) = 1 then [w[1]]
      else list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) end) s from words)
), sizes as (select doc_id, count(*) n from sets group by 1),
links as (
  select x.doc_id a, y.doc_id b from sets x join sets y on x.s = y.s and x.doc_id <> y.doc_id
  join sizes p on p.doc_id = x.doc_id join sizes q on q.doc_id = y.doc_id
  group by x.doc_id, y.doc_id, p.n, q.n having 100 * count(*) >= 80 * (p.n + q.n - count(*))
), reach as (
  select a, b from links union select r.a, l.b from reach r join links l on r.b = l.a
), least_of as (select a, min(b) m from reach group by a)
select d.doc_id, coalesce(s.n, 0) n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) component_id,
       d.doc_id <= coalesce(m, d.doc_id) kept
from documents d left join sizes s using (doc_id) left join least_of l on l.a = d.doc_id
"""

_CONTAINED = f"""
with words as (
  select 0 kind, doc_id id, {_WORDS.format("lower(coalesce(text, ''))")} w from documents
  union all select 1, item_id, {_WORDS.format("lower(coalesce(text, ''))")} from benchmark
), widths as (
  select distinct least(len(w), 5) k from words where kind = 1 and len(w) > 0
), shingles as (
  select distinct kind, id, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) s
  from words, widths where len(w) >= k and (kind = 0 or k = least(len(w), 5))
), sizes as (select id, count(*) n from shingles where kind = 1 group by 1)
select d.id doc_id, i.id item_id, n n_item, count(*) n_shared, count(*) / n containment
from shingles d join shingles i on d.s = i.s and d.kind = 0 and i.kind = 1 join sizes z on z.id = i.id
group by d.id, i.id, n having 100 * count(*) >= 80 * n
"""

_QUALITY = f"""
with docs as materialized (
  select doc_id, source, coalesce(text, '') t, {_WORDS.format("coalesce(text, '')")} w from documents
), lines as (
  select doc_id, source, unnest(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]'))) l from docs
), dup as (select doc_id, count(*) - count(distinct l) n from lines group by 1),
normal as (
  select doc_id, source, array_to_string({_WORDS.format("lower(l)")}, ' ') line, len({_WORDS.format("l")}) n from lines
), frequent as (
  select source, line from normal group by 1, 2 having count(distinct doc_id) > 30
), removed as (
  select doc_id, sum(n) n from normal x join frequent f on x.line = f.line and x.source is not distinct from f.source group by 1
), windows as (
  select doc_id, i, array_to_string(w[i:i + 2], ' ') g from (select doc_id, w, unnest(range(1, len(w) - 1)) i from docs)
), twice as (
  select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, g) c from windows) where c > 1
), covered as (select doc_id, count(distinct i + o) n from twice, range(0, 3) t(o) group by 1),
base as (
  select doc_id, len(w)::bigint n_words, length(array_to_string(w, ''))::bigint word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint n_symbols, coalesce(dup.n, 0)::bigint n_dup_lines,
    coalesce(covered.n, 0)::bigint n_repeat_words, coalesce(removed.n, 0)::bigint n_removed_words
  from docs left join dup using (doc_id) left join covered using (doc_id) left join removed using (doc_id)
)
select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words base_failed,
  not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and n_words - n_removed_words >= 0.5 * n_words kept from base
"""

_DRAWS = [f"('0x' || substr(md5(coalesce(doc_id::varchar, 'null') || ':{k}'), {8 * i + 1}, 8))::bigint / 4294967296.0"
          for k in range(4) for i in range(4)]
_MIX = f"""
with recursive docs as materialized (
  select doc_id, source, len({_WORDS.format("coalesce(text, '')")})::bigint size from documents
), src as (
  select source, s, [1, 2, 3][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int]::bigint w
  from (select source, sum(size)::bigint s from docs group by 1)
), fill as (
  select (select sum(s) from src)::hugeint a, (select sum(w) from src)::hugeint b
  union
  select (select sum(s) from src)::hugeint - coalesce(sum(3 * s) filter (w * a > 3 * s * b), 0)::hugeint,
         coalesce(sum(w) filter (w * a <= 3 * s * b), 1)::hugeint
  from fill, src group by a, b
), last as (select a, b from fill order by a, b limit 1
), goal as (
  select source, s, case when w * a > 3 * s * b then (3 * s)::double else (w * a)::double / b::double end target from src, last
), rated as (
  select *, case when s > 0 then target / s else 0 end rate from goal
), drawn as (
  select d.*, r.s source_size, r.target, floor(r.rate) whole, r.rate - floor(r.rate) part, [{", ".join(_DRAWS)}] u
  from docs d join rated r on d.source is not distinct from r.source
), misses as (
  select source, k, abs(any_value(whole) * any_value(source_size) + sum(case when u[k] < part then size else 0 end)
                        - any_value(target)) miss
  from drawn, range(1, 17) t(k) group by 1, 2
), best as (select source, min_by(k, (miss, k)) k from misses group by 1)
select doc_id, size, source_size, target, (size * (whole + (u[k] < part)::int))::bigint taken
from drawn d join best b on d.source is not distinct from b.source
"""

#: Bytes of a feature as a list, its CRC-32 by a table of 256 steps.
_RESAMPLE = rf"""
with recursive steps as materialized (
  select list(list_reduce([i] || range(8), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by i) t
  from range(256) r(i)
), words as materialized (
  select kind, no, doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w
  from (select 0 kind, row_number() over () no, doc_id, text from documents union all select 1, 0, null, text from benchmark)
), runs as materialized (
  select kind, no, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) f
  from words, range(1, 4) t(n) where len(w) >= n
), hashed as materialized (
  select f, xor(list_reduce([4294967295::bigint] || list_transform(range(octet_length(encode(f))), lambda i: ('0x' || substr(hex(encode(f)), 2 * i::int + 1, 2))::bigint),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 b
  from (select distinct f from runs), steps
), counts as (
  select kind, no, b, count(*) n from runs join hashed using (f) group by all
), buckets as (
  select b, coalesce(sum(n) filter (kind = 0), 0)::bigint s, coalesce(sum(n) filter (kind = 1), 0)::bigint t from counts group by 1
), total as (select sum(s)::bigint s, sum(t)::bigint t from buckets),
gains as (
  select b, floor(1000 * ln(((x.t + 1)::double * (y.s + 10000)::double) / ((x.s + 1)::double * (y.t + 10000)::double)))::bigint gain
  from buckets x, total y
), weighed as (
  select no, sum(n * gain)::bigint weight, sum(n)::bigint n_features from counts join gains using (b) where kind = 0 group by 1
), scored as (
  select doc_id, len(w) n_words, coalesce(n_features, 0) n_features, coalesce(weight, 0) weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(doc_id::varchar, 'null')), 1, 8))::bigint + 0.5) / 4294967296.0::double)))::bigint score
  from words left join weighed using (no) where kind = 0
), placed as (
  select *, n_words >= 20 long, row_number() over (partition by n_words >= 20 order by score desc, doc_id nulls last) place,
    floor(5 * (count(*) over (partition by n_words >= 20)) / 100) drawn from scored
)
select doc_id, n_features, weight, score, case when long and place <= drawn then place end rank from placed
"""

_TERMS = rf"unnest(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) term"
_SEARCH = f"""
with counts as materialized (
  select no, doc_id, term, count(*) tf from (select no, doc_id, {_TERMS} from (select *, row_number() over () no from documents)) group by all
), sizes as (select no, sum(tf)::bigint n from counts group by 1),
total as (select count(*) nd, sum(n)::bigint l from sizes),
weights as (
  select term, floor(1000 * ln((2 * nd + 2)::double / (2 * count(*) + 1)::double))::bigint w from counts, total group by term, nd
), lengths as (select no, 25 + (75 * n * nd) // l m from sizes, total),
asked as (select item_id, term, count(*) c from (select item_id, {_TERMS} from benchmark) where item_id is not null group by all),
scores as (
  select item_id, no, doc_id, sum(c * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint score
  from asked join counts using (term) join weights using (term) join lengths using (no) group by all
)
select item_id, rank::int rank, doc_id, score from (
  select *, row_number() over (partition by item_id order by score desc, doc_id nulls last) rank from scores where score > 0) where rank <= 10
"""

SQL: dict[str, str] = {
    "op12_importance_resampling": _RESAMPLE,
    "op13_ranked_search": _SEARCH,
    "op5_quality_rules": _QUALITY,
    "op9_benchmark_decontamination": _CONTAINED,
    "op10_mix_sources": _MIX,
    "op4_minhash_near_dedup": _NEAR,
}
