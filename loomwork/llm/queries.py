"""The registered queries of this subpackage, each over whole tables, and SQL that checks them."""

from __future__ import annotations

import public_tokenizers

from pyspark.sql import functions as F

from . import (
    decontaminate, extraction, fill_middle, licenses, lm_scoring, mixing, passages, quality_rules, repeats, simhash,
    token_files, vector_codes, warc,
)

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark, sf_dir):
    """Base measures, lines failed by each rule, and verdict of every document."""
    return quality_rules.measure(_table(spark, sf_dir, "documents"))


def op2_token_files(spark, sf_dir):
    """Every document's place, size and check sum, from files of directly addressable codes."""
    read = token_files.round_trip(_table(spark, sf_dir, "documents"), TOKENIZER)
    return read.select("doc_id", "start", "n_tokens", "ids_crc32")


def op3_mixing(spark, sf_dir):
    """Words that a mix of all sources takes of every document."""
    return mixing.mixture(_table(spark, sf_dir, "documents"))


def op4_extraction(spark, sf_dir):
    """Main text of every page."""
    return extraction.extract(_table(spark, sf_dir, "pages"))


def op5_lm_scoring(spark, sf_dir):
    """Cross-entropy difference of every document: good documents as target, all as background."""
    good = _table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    rows = lm_scoring.difference(_table(spark, sf_dir, "documents"), good)
    exact = [F.round(c, 6).alias(c) for c in ("target_loss", "background_loss", "score")]  # sums depend on their order
    return rows.select("doc_id", "n_tokens", *exact)


def op6_warc(spark, sf_dir):
    """What the archives say of every page, after writing them and reading them back."""
    return warc.archive_and_read(_table(spark, sf_dir, "pages"))


def op7_simhash(spark, sf_dir):
    """Component of every document over fingerprints at most three bits apart."""
    groups = simhash.near_groups(_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


def op8_passages(spark, sf_dir):
    """Quality of every document by a model of its passages."""
    docs = _table(spark, sf_dir, "documents")
    return passages.predict(docs, passages.train(docs, _table(spark, sf_dir, "labels")))


def op9_licenses(spark, sf_dir):
    """License texts in every document."""
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op10_decontaminate(spark, sf_dir):
    """Benchmark passages in every document, and whether they contaminate it."""
    return decontaminate.inspect(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_vector_codes(spark, sf_dir):
    """Codes and errors of every vector that has finite components only."""
    return vector_codes.coded(_table(spark, sf_dir, "embeddings"))


def op12_fill_middle(spark, sf_dir):
    """Form, cuts and check sums of every document made ready for filling in its middle."""
    return fill_middle.digests(_table(spark, sf_dir, "documents"))


def op13_repeats(spark, sf_dir):
    """What every document keeps without the byte strings that occur more than once."""
    return repeats.digests(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_token_files": op2_token_files,
    "op3_mixing": op3_mixing,
    "op4_extraction": op4_extraction,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_warc": op6_warc,
    "op7_simhash": op7_simhash,
    "op8_passages": op8_passages,
    "op9_licenses": op9_licenses,
    "op10_decontaminate": op10_decontaminate,
    "op11_vector_codes": op11_vector_codes,
    "op12_fill_middle": op12_fill_middle,
    "op13_repeats": op13_repeats,
}

_WHITE = r"[ \t\n\x0B\f\r]"
_RULES = quality_rules.Rules()

# Words, lines and windows as lists; a word is covered when one of the windows
# that hold it is found twice or more in its text.
_QUALITY_SQL = f"""
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
w as (select r, list_filter(regexp_split_to_array(text, '{_WHITE}+'), lambda x: x <> '') as ws from d),
runs as (select r, i, array_to_string(list_slice(ws, i, i + {_RULES.window - 1}), ' ') as run
  from (select r, ws, unnest(range(1, len(ws) - {_RULES.window - 2})) as i from w where len(ws) > {_RULES.window})),
often as (select r, i from (select r, i, count(*) over (partition by r, run) as n from runs) where n > 1),
rep as (select r, count(distinct i + k) as n_repeat from often, range({_RULES.window}) t(k) group by r),
lines as (select r, i, ls[i] as line from (select r, ls, unnest(range(1, len(ls) + 1)) as i
  from (select r, string_split(text, chr(10)) as ls from d))),
facts as (select r, line,
  row_number() over (partition by r, line order by i) > 1 and regexp_matches(line, '[^ \\t\\x0B\\f\\r]') as dup,
  length(regexp_replace(line, '{_WHITE}', '', 'g')) as chars,
  length(line) - length(regexp_replace(line, '{quality_rules.PUNCTUATION}', '', 'g')) as marks,
  length(line) - length(replace(line, '|', '')) as bars,
  list_filter(regexp_split_to_array(line, '{_WHITE}+'), lambda x: x <> '') as ws,
  regexp_matches(lower(line), '{quality_rules.BOILERPLATE}') as phrase from lines),
judged as (select *, case
  when marks >= {_RULES.min_punctuation} and 100 * marks > {_RULES.max_punctuation} * chars then 'p'
  when bars >= {_RULES.min_bars} and 100 * bars > {_RULES.max_bars} * len(ws) then 'n'
  when phrase and len(ws) <= {_RULES.boilerplate_words} then 'b'
  when stutter >= {_RULES.min_stutter} and 2 * stutter > len(ws) then 'b' end as failed
  from (select *, len(list_filter(range(1, len(ws)), lambda i: ws[i] = ws[i + 1])) as stutter from facts)),
per as (select r, count(*) filter (dup) as n_dup_lines,
  coalesce(sum(chars) filter (failed is not null), 0)::bigint as lost_chars,
  count(*) filter (failed = 'p') as n_punctuation_lines, count(*) filter (failed = 'n') as n_navigation_lines,
  count(*) filter (failed = 'b') as n_boilerplate_lines from judged group by r),
m as (select doc_id, len(ws)::bigint as n_words,
  length(regexp_replace(text, '{_WHITE}', '', 'g'))::bigint as word_chars,
  (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
  coalesce(n_repeat, 0)::bigint as n_repeat_words, per.* exclude (r)
  from d join w using (r) join per using (r) left join rep using (r))
select *, not base_failed and 100 * lost_chars <= {_RULES.max_loss} * word_chars as kept
from (select *, n_words < {_RULES.min_words} or 100 * n_repeat_words > {_RULES.max_repeat} * n_words as base_failed from m)
"""

_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_PLAIN = r"[\x01-\x2F\x3A-\x60\x7B-\x7F]+"
_RULE = decontaminate.Rule()

# Item windows joined with document windows of the same length.
_BENCHMARK_SQL = f"""
with d as (select row_number() over () as r, doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), '{_LETTERS}', '{_LETTERS.lower()}'), '{_PLAIN}'), lambda x: x <> '') as ws from documents),
b as (select item_id, ws, least(len(ws), {_RULE.window}) as k from (select item_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), '{_LETTERS}', '{_LETTERS.lower()}'), '{_PLAIN}'), lambda x: x <> '') as ws from benchmark)
  where len(ws) > 0),
iw as (select distinct item_id, k, array_to_string(list_slice(ws, i, i + k - 1), ' ') as win
  from (select *, unnest(range(1, len(ws) - k + 2)) as i from b)),
dw as (select r, i, k, array_to_string(list_slice(ws, i, i + k - 1), ' ') as win
  from (select r, ws, k, unnest(range(1, len(ws) - k + 2)) as i from d, (select distinct k from iw) where len(ws) >= k)),
occ as (select r, i, k, item_id from dw join iw using (k, win)),
hits as (select r, count(distinct i + j) as n_hit from occ, range({_RULE.window}) t(j) where j < k group by r),
found as (select r, count(distinct item_id) as n_items,
  sha256(array_to_string(list_sort(list(distinct item_id::varchar)), ',')) as items_sha256 from occ group by r),
runs as (select r, min(i) - 1 as s, max(i + k) - min(i) as n from (select r, i, k,
    i - row_number() over (partition by r order by i) as g from (select r, i, max(k) as k from occ group by r, i)) group by r, g),
best as (select r, n, s from (select *, row_number() over (partition by r order by n desc, s) as p from runs) where p = 1),
m as (select doc_id, len(ws)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  coalesce(items_sha256, sha256('')) as items_sha256, coalesce(n, 0)::bigint as longest_match, coalesce(s, -1)::bigint as longest_at
  from d left join hits using (r) left join found using (r) left join best using (r))
select *, n_hit > 0 and {_RULE.share} * n_hit >= n_words as contaminated from m
"""

_MIX = mixing.Mix()

# Water-filling, then one running sum over each source in the order of the hash.
_MIX_SQL = f"""
with d as (select doc_id, source, md5('{_MIX.seed}:' || coalesce(doc_id::varchar, '')) as h,
  len(list_filter(regexp_split_to_array(coalesce(text, ''), '{_WHITE}+'), lambda x: x <> ''))::bigint as size from documents),
s as (select source, sum(size)::bigint as source_size from d group by source),
w as (select *, {_MIX.max_epochs} * source_size as cap, ([{", ".join(map(str, _MIX.weights))}])[
    (row_number() over (order by source nulls last) - 1) % {len(_MIX.weights)} + 1] as w,
  sum(source_size) over () * {_MIX.percent} / 100.0::double as total from s),
l as (select *, cap / w::double as room from w),
v as (select *, (total - coalesce(sum(cap) over (order by room, source nulls last rows between unbounded preceding and 1 preceding), 0))
  / sum(w) over (order by room, source nulls last rows between current row and unbounded following) as level from l),
t as (select source, source_size, coalesce(least(cap::double, w * (select min_by(level, room) from v where level < room)), cap::double) as target from v),
e as (select *, coalesce(floor(target / nullif(source_size, 0)), 0)::bigint as whole from t),
r as (select doc_id, size, source_size, target, whole, round(target - whole * source_size)::bigint as extra,
  coalesce(sum(size) over (partition by d.source order by h, size rows between unbounded preceding and 1 preceding), 0) as before
  from d join e on d.source is not distinct from e.source)
select doc_id, size, source_size, target, (whole * size + greatest(0, least(extra - before, size)))::bigint as taken from r
"""

# Base32 of the 40 hexadecimal digits of SHA-1: five of them are four characters.
_WARC_SQL = """
with p as (select page_id, strlen(coalesce(html, ''))::bigint as payload_bytes, sha1(coalesce(html, '')) as h from pages),
f as (select h, min(page_id) as first from p group by h)
select page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i:
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + ((('0x' || h[i // 4 * 5 + 1 : i // 4 * 5 + 5])::bigint >> (15 - i % 4 * 5)) & 31)]), '') as payload_digest,
  case when page_id is not distinct from first then 'response' else 'revisit' end as record_type,
  case when page_id is distinct from first then first end as refers_to
from p join f using (h)
"""

_LM = lm_scoring.Settings()

# Counts of words and of pairs, joined back to every word; '' stands before a text.
_LM_SQL = f"""
with d as (select row_number() over () as r, doc_id, (doc_id in (select doc_id from labels where quality = 1))::int as t,
  list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{_LETTERS}', '{_LETTERS.lower()}'), '{_WHITE}+'), lambda x: x <> '') as ws from documents),
w as (select r, t, ws[i] as w, case when i > 1 then ws[i - 1] else '' end as v from (select *, unnest(range(1, len(ws) + 1)) as i from d)),
n as (select count(*) as nb, coalesce(sum(t), 0) as nt from w),
one as (select w, sum(t) as ct, count(*) as cb from w group by w),
context as (select w as v, ct, cb from one union all select '', sum(t), count(*) from d where len(ws) > 0),
pair as (select v, w, sum(t) as ct, count(*) as cb from w group by v, w),
p as (select pair.*, one.cb / greatest(1, nb) as pb, (one.ct + {_LM.unigram_prior} * (one.cb / greatest(1, nb))) / (nt + {_LM.unigram_prior}) as pt
  from pair join one using (w), n),
loss as (select p.v, p.w, -ln((p.ct + {_LM.prior} * pt) / (context.ct + {_LM.prior})) as lt,
  -ln((p.cb + {_LM.prior} * pb) / (context.cb + {_LM.prior})) as lb from p join context using (v)),
s as (select r, avg(lt) as lt, avg(lb) as lb from w join loss using (v, w) group by r)
select doc_id, len(ws)::bigint as n_tokens, round(coalesce(lt, 0), 6) as target_loss, round(coalesce(lb, 0), 6) as background_loss,
  round(coalesce(lt - lb, 0), 6) as score from d left join s using (r)
"""

_CODING = vector_codes.Coding()


def _vector_sql() -> str:
    """The same rounds over one row for each part of a vector, with all distances in all of them."""
    n = _CODING.parts

    def assigned(r: int) -> str:
        dist = "list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i])))"
        return f"""a{r} as materialized (select r, p, x, (arg_min(struct_pack(e := e, d := d), (d, e))).e as e, min(d) as d
  from (select r, p.p, x, e, {dist} as d from p join c{r} on p.p = c{r}.p) group by r, p, x)"""

    def moved(r: int) -> str:
        return f"""m{r} as materialized (select p, e, list(v order by i) as c from (select p, e, i, floor(sum(x[i])::hugeint / count(*))::bigint as v
    from (select p, e, x, unnest(range(1, len(x) + 1)) as i from a{r}) group by p, e, i) group by p, e),
c{r + 1} as materialized (select c{r}.p, c{r}.e, coalesce(m{r}.c, c{r}.c) as c from c{r} left join m{r} on c{r}.p = m{r}.p and c{r}.e = m{r}.e)"""

    rounds = ",\n".join(f"{assigned(r)},\n{moved(r)}" for r in range(_CODING.rounds))
    last = _CODING.rounds
    return f"""
with v as (select row_number() over (order by vec_id nulls last, embedding) as r, vec_id, label,
    list_transform(embedding, lambda x: floor({_CODING.scale} * x::double)::bigint) as x from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
p as materialized (select r, p, list_slice(x, p * w + 1, (p + 1) * w) as x from (select r, x, len(x) // {n} as w, unnest(range({n})) as p from v)),
c0 as materialized (select p, r - 1 as e, x as c from p where r <= {_CODING.entries}),
{rounds},
{assigned(last)},
books as (select sha256(string_agg(v::varchar, ',' order by p, e, i)) as codebooks_sha256
  from (select p, e, unnest(c) as v, generate_subscripts(c, 1) as i from c{last})),
codes as (select r, string_agg(printf('%02x', e::int), '' order by p) as code, sum(d)::bigint as error from a{last} group by r),
out as (select vec_id, label, code, error from v join codes using (r))
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256 from out, books
"""


_FORM = fill_middle.Form()

# Units as a list, so that every cut is a position in it.
_FILL_SQL = f"""
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as text,
    sha256('{_FORM.salt}:' || coalesce(doc_id::varchar, '')) as h from documents),
u as (select *, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') as us,
    [('0x' || h[8 * i + 1 : 8 * i + 8])::bigint for i in range(4)] as hs from d),
n as (select *, len(us) as n, text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>')
    or hs[3] % 100 >= {_FORM.plain_from} as plain, hs[4] % 100 < {_FORM.spm_below} as spm from u),
c as (select *, least(hs[1] % (n + 1), hs[2] % (n + 1)) as a, greatest(hs[1] % (n + 1), hs[2] % (n + 1)) as b from n),
t as (select *, array_to_string(us[1:a], '') as p, array_to_string(us[a + 1 : b], '') as m, array_to_string(us[b + 1 :], '') as s from c)
select doc_id, n::bigint as n, case when plain then 'plain' when spm then 'spm' else 'psm' end as form,
  case when not plain then length(p) end::bigint as prefix_chars, case when not plain then length(m) end::bigint as middle_chars,
  sha256(case when plain then text when spm then '<S>' || s || '<P>' || p || '<M>' || m else '<P>' || p || '<S>' || s || '<M>' || m end) as output_sha256,
  sha256(text) as restored_sha256 from t
"""

_WINDOW = repeats.Repeats().window

# Every window of every text by its hash; bytes as hexadecimal digits, of which two are a byte.
_REPEATS_SQL = f"""
with d as materialized (select row_number() over () as r, doc_id, hex(encode(coalesce(text, ''))) as h from documents),
w as (select r, i, md5_number(substr(h, 2 * i - 1, {2 * _WINDOW})) as win
  from (select r, h, unnest(range(1, (length(h) // 2 - {_WINDOW} + 2)::bigint)) as i from d)),
hit as (select r, i from (select r, i, count(*) over (partition by win) as n from w) where n > 1),
spans as materialized (select r, min(i) as a, max(i) + {_WINDOW} as b from (select r, i, sum(new) over (partition by r order by i) as span
  from (select r, i, case when i > lag(i) over (partition by r order by i) + {_WINDOW} then 1 else 0 end as new from hit)) group by r, span),
gaps as (select r, a, lead(a) over (partition by r order by a) as next, b, row_number() over (partition by r order by a) as k from spans),
kept as (select r, sum(b - a)::bigint as n_removed, count(*) as n_spans,
    string_agg(case when k = 1 then substr(h, 1, 2 * (a - 1)::bigint) else '' end
      || substr(h, 2 * b - 1, 2 * (coalesce(next, length(h) // 2 + 1) - b)::bigint), '' order by a) as h
  from gaps join d using (r) group by r)
select doc_id, (length(d.h) // 2)::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0)::bigint as n_spans,
  sha256(unhex(coalesce(kept.h, d.h))) as kept_sha256 from d left join kept using (r)
"""

ORACLES = {
    "op1_quality_rules": _QUALITY_SQL, "op3_mixing": _MIX_SQL, "op5_lm_scoring": _LM_SQL, "op6_warc": _WARC_SQL,
    "op10_decontaminate": _BENCHMARK_SQL, "op11_vector_codes": _vector_sql(), "op12_fill_middle": _FILL_SQL,
    "op13_repeats": _REPEATS_SQL,
}
