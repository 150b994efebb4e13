"""DuckDB SQL of the queries whose rows SQL can express, written from their definitions alone."""

from __future__ import annotations

_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

OP1 = rf"""
with split as (
    select
        doc_id,
        coalesce(text, '') as body,
        {_WORDS} as words,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
    from documents
),
windows as (
    select doc_id, pos, md5(array_to_string(list_slice(words, pos, pos + 7), chr(10))) as gram
    from (select doc_id, words, unnest(range(1, greatest(len(words) - 6, 1))) as pos from split)
),
twice as (
    select doc_id, pos from windows
    qualify count(*) over (partition by doc_id, gram) > 1
),
covered as (
    select doc_id, count(distinct pos + step) as n
    from twice, (select unnest(range(0, 8)) as step)
    group by doc_id
),
counted as (
    select
        doc_id,
        cast(len(words) as bigint) as n_words,
        cast(length(array_to_string(words, '')) as bigint) as word_chars,
        cast(length(regexp_replace(body, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
        cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
        cast(coalesce(n, 0) as bigint) as n_repeat_words,
        length(regexp_replace(body, '[^!]', '', 'g')) as n_exclamations,
        len(lines) as n_lines,
        len(list_filter(words, lambda w: list_contains([
            'the', 'of', 'and', 'to', 'in', 'a', 'is', 'that', 'for', 'it', 'as', 'was', 'with', 'be', 'by', 'on',
            'are', 'this', 'le', 'la', 'les', 'de', 'des', 'du', 'et', 'un', 'une', 'que', 'qui', 'en', 'au', 'est',
            'pour', 'dans', 'pas', 'sur', 'der', 'die', 'das', 'und', 'den', 'von', 'zu', 'mit', 'sich', 'ist',
            'ein', 'eine', 'nicht', 'auf', 'dem', 'im', 'als', 'el', 'los', 'las', 'y', 'con', 'se', 'del', 'por',
            'su', 'al', 'no', 'es', 'una', 'para', 'lo', 'como'
        ], lower(w)))) as n_stop_words
    from split left join covered using (doc_id)
),
judged as (
    select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from counted
)
select
    doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    not base_failed
        and 100 * word_chars >= 200 * n_words and 100 * word_chars <= 1200 * n_words
        and 100 * n_symbols <= 20 * n_words
        and 100 * n_exclamations <= 20 * n_words
        and 100 * n_stop_words >= 4 * n_words
        and 100 * n_dup_lines <= 50 * n_lines as kept
from judged
"""

OP7 = rf"""
with recursive split as (
    select
        doc_id,
        list_filter(
            string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x20\x09-\x0D]+'
            ),
            lambda x: x <> ''
        ) as words
    from documents
),
shingles as (
    select distinct doc_id, md5(array_to_string(list_slice(words, pos, pos + 4), chr(10))) as shingle
    from (select doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) as pos from split where len(words) > 0)
),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
shared as (
    select x.doc_id as a, y.doc_id as b, count(*) as n
    from shingles x join shingles y on x.shingle = y.shingle and x.doc_id <> y.doc_id
    group by 1, 2
),
links as (
    select a, b
    from shared join sizes x on a = x.doc_id join sizes y on b = y.doc_id
    where 100 * shared.n >= 75 * (x.n + y.n - shared.n)
),
reached as (
    select doc_id as start, doc_id as pos from documents
    union
    select start, b from reached join links on pos = a
)
select
    start as doc_id,
    cast(coalesce(any_value(n), 0) as bigint) as n_shingles,
    min(pos) as component_id,
    min(pos) = start as kept
from reached left join sizes on start = sizes.doc_id
group by start
"""

OP8 = """
with bits as (
    select
        page_id,
        cast(strlen(coalesce(html, '')) as bigint) as payload_bytes,
        array_to_string(
            list_transform(
                string_split(sha1(coalesce(html, '')), ''),
                lambda c: right(bin(cast(strpos('0123456789abcdef', c) - 1 + 16 as integer)), 4)
            ),
            ''
        ) as digits
    from pages
),
digested as (
    select
        page_id,
        payload_bytes,
        array_to_string(
            list_transform(
                range(0, 32),
                lambda i: substr(
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                    1 + 16 * cast(substr(digits, 5 * i + 1, 1) as integer)
                      + 8 * cast(substr(digits, 5 * i + 2, 1) as integer)
                      + 4 * cast(substr(digits, 5 * i + 3, 1) as integer)
                      + 2 * cast(substr(digits, 5 * i + 4, 1) as integer)
                      + cast(substr(digits, 5 * i + 5, 1) as integer),
                    1
                )
            ),
            ''
        ) as payload_digest
    from bits
)
select
    page_id,
    payload_bytes,
    payload_digest,
    case when page_id = last then 'response' else 'revisit' end as record_type,
    case when page_id = last then null else last end as refers_to
from (select *, max(page_id) over (partition by payload_digest) as last from digested)
"""

OP9 = """
with bytes as (
    select doc_id, hex(encode(coalesce(text, ''))) as body, strlen(coalesce(text, '')) as n from documents
),
windows as (
    select doc_id, pos, md5(substr(body, 2 * pos + 1, 200)) as gram
    from (select doc_id, body, unnest(range(0, greatest(n - 99, 0))) as pos from bytes)
),
repeated as (
    select doc_id, pos from windows
    qualify row_number() over (partition by gram order by doc_id, pos) > 1
),
marked as (
    select doc_id, pos, pos > coalesce(lag(pos) over (partition by doc_id order by pos) + 100, -1) as opens
    from repeated
),
runs as (
    select doc_id, min(pos) as start, max(pos) + 100 as stop
    from (select *, sum(cast(opens as integer)) over (partition by doc_id order by pos) as run from marked)
    group by doc_id, run
),
gaps as (
    select doc_id, start, stop, coalesce(lag(stop) over (partition by doc_id order by start), 0) as before from runs
),
cut as (
    select
        doc_id,
        cast(sum(stop - start) as bigint) as n_removed,
        count(*) as n_spans,
        max(stop) as last,
        string_agg(substr(body, 2 * before + 1, 2 * (start - before)), '' order by start) as head
    from gaps join bytes using (doc_id)
    group by doc_id
)
select
    doc_id,
    cast(n as bigint) as n_bytes,
    coalesce(n_removed, 0) as n_removed,
    coalesce(n_spans, 0) as n_spans,
    sha256(unhex(coalesce(head, '') || substr(body, 2 * coalesce(last, 0) + 1))) as kept_sha256
from bytes left join cut using (doc_id)
"""



def _crc_table() -> str:
    """What the CRC-32 polynomial (bits in reverse) makes of each byte, as a SQL list."""
    values = list(range(256))
    for _ in range(8):
        values = [v >> 1 ^ 0xEDB88320 * (v & 1) for v in values]
    return f"([{', '.join(map(str, values))}]::bigint[])"


def _crc(text: str) -> str:
    """The CRC-32 of the UTF-8 bytes of a text."""
    start = 0xFFFFFFFF
    bytes_ = f"""list_transform(
        range(0, octet_length(encode({text}))),
        lambda i: cast('0x' || substr(hex(encode({text})), cast(2 * i + 1 as integer), 2) as bigint)
    )"""
    return f"""xor({start}::bigint, list_reduce(
        list_prepend({start}::bigint, {bytes_}),
        lambda c, b: xor(c >> 8, {_crc_table()}[(xor(c, b) & 255) + 1])
    ))"""


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP12 = rf"""
with recursive runs as (
    select doc_id, run, count(*) as times
    from (select doc_id, unnest(regexp_extract_all({_LOWER}, '[a-z\x{{C0}}-\x{{FF}}]+')) as run from documents)
    group by doc_id, run
),
checked as (select run, times, {_crc("concat(doc_id, ':', run)")} as h from runs),
words as (
    select word, cast(sum(times) as bigint) as n
    from (
        select
            times,
            case
                when h % 97 = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
                else run
            end as word
        from checked
    )
    where length(word) >= 5
    group by word
    having sum(times) >= 3
),
shorter as (
    select word, n, place, substr(word, 1, place) || substr(word, place + 2) as rest
    from (select word, n, unnest(range(0, length(word))) as place from words)
),
near as (
    select a.word as a, b.word as b, b.n as n
    from shorter as a join shorter as b on a.rest = b.rest and a.place = b.place and a.word <> b.word
    union
    select a.word, b.word, b.n from shorter as a join words as b on a.rest = b.word
    union
    select b.word, a.word, a.n from shorter as a join words as b on a.rest = b.word
),
best as (select a as word, count(*) as n_near, first(b order by n desc, b) as b, max(n) as b_n from near group by a),
formed as (
    select
        words.word,
        words.n,
        coalesce(n_near, 0) as n_near,
        case when b_n >= 2 * words.n then b end as form,
        case when b_n >= 2 * words.n then b_n end as form_n
    from words left join best using (word)
),
chains as (
    select word, word as at from formed
    union all
    select chains.word, formed.form from chains join formed on formed.word = chains.at where formed.form is not null
),
roots as (
    select chains.word, chains.at as root from chains join formed on formed.word = chains.at where formed.form is null
)
select formed.word, form, root, n, n_near, form_n from formed join roots using (word)
"""

OP13 = rf"""
with given as (
    select true as document, doc_id, text from documents union all select false, null, text from benchmark
),
features as (
    select document, doc_id, unnest(regexp_extract_all({_LOWER}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')) as word from given
),
crcs as (select word, {_crc("word")} % 10000 as bucket from (select distinct word from features)),
bucketed as (select document, doc_id, bucket from features join crcs using (word)),
counts as (
    select
        bucket,
        cast(count(*) filter (document) as double) as s,
        cast(count(*) filter (not document) as double) as t
    from bucketed group by bucket
),
totals as (select sum(s) as s_all, sum(t) as t_all from counts),
gains as (
    select
        bucket,
        cast(floor(1000 * ln((t + 1) * (s_all + 10000) / ((s + 1) * (t_all + 10000)))) as bigint) as gain
    from counts, totals
),
weights as (
    select doc_id, count(*) as n_features, cast(sum(gain) as bigint) as total
    from bucketed join gains using (bucket) where document group by doc_id
),
scored as (
    select
        doc_id,
        coalesce(n_features, 0) as n_features,
        case
            when n_features > 0 then total // n_features - case when total % n_features < 0 then 1 else 0 end
            else 0
        end as weight,
        cast('0x' || substr(sha256('2024:' || doc_id), 1, 8) as bigint) as h
    from documents left join weights using (doc_id)
),
noisy as (
    select
        doc_id,
        n_features,
        cast(weight as bigint) as weight,
        cast(weight + floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296::double))) as bigint) as score
    from scored
),
eligible as (
    select doc_id, row_number() over (order by score desc, doc_id) as place, count(*) over () as n
    from noisy where n_features >= 20
)
select doc_id, n_features, weight, score, cast(place as bigint) as rank
from noisy left join (select * from eligible where place <= 10 * n // 100) using (doc_id)
"""

ORACLE = {
    "op1_quality_rules": OP1,
    "op7_minhash_near_dedup": OP7,
    "op8_warc": OP8,
    "op9_suffix_dedup": OP9,
    "op12_spelling_variants": OP12,
    "op13_resampling": OP13,
}
