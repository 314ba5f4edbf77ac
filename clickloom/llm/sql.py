"""SQL of the queries that SQL can express, written from the definitions of their results."""

from __future__ import annotations

_WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"
_LOWER_AZ = ("translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")

OP1 = f"""
    with cut as (
        select page_id, url,
               case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3)
                    else '' end as rest
        from pages),
    parts as (
        select row_number() over () as n, page_id,
               {_LOWER_AZ.format(text="regexp_extract(coalesce(rest, ''), '^[^/?#]*')")} as host,
               regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) as path
        from cut),
    rules(verdict, host, path) as (
        values ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
               ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'),
               ('block', 'net', '/fr/')),
    fits as (
        select p.n, r.host || r.path as rule, r.verdict,
               row_number() over (partition by p.n
                                  order by length(r.host) + length(r.path) desc) as k
        from parts p join rules r
          on (p.host = r.host or ends_with(p.host, '.' || r.host))
         and starts_with(p.path, r.path))
    select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict
    from parts left join (select * from fits where k = 1) f using (n)"""

OP3 = f"""
    with recursive tokens as (
        select doc_id, {_WORDS.format(text=_LOWER_AZ.format(text="coalesce(text, '')"))} as w
        from documents),
    shingles as (
        select distinct doc_id, unnest(
            case when len(w) >= 3
                 then list_transform(range(1, len(w) - 1),
                                     lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
                 when len(w) > 0 then [array_to_string(w, ' ')]
                 else [] end) as s
        from tokens),
    sizes as (select doc_id, count(*) as n from shingles group by doc_id),
    shared as (
        select a.doc_id as a, b.doc_id as b, count(*) as n_both
        from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id
        group by a.doc_id, b.doc_id),
    links as (
        select shared.a, shared.b
        from shared join sizes x on x.doc_id = shared.a join sizes y on y.doc_id = shared.b
        where 100 * n_both >= 85 * (x.n + y.n - n_both)),
    reached(doc_id, other) as (
        select doc_id, doc_id from documents
        union
        select r.doc_id, l.b from reached r join links l on l.a = r.other)
    select d.doc_id, coalesce(any_value(n), 0) as n_shingles, min(other) as component_id,
           d.doc_id = min(other) as kept
    from (select doc_id from documents) d join reached using (doc_id)
         left join sizes using (doc_id)
    group by d.doc_id"""

_FURNITURE = ("cookie|privacy policy|terms of use|terms of service|all rights reserved|"
              "subscribe to|sign up|log in|click here|read more|share this|javascript|lorem ipsum")

OP8 = rf"""
    with texts as (
        select row_number() over () as k, doc_id, coalesce(text, '') as text from documents),
    split as (
        select k, doc_id, text, {_WORDS.format(text="text")} as w,
               list_filter(string_split(text, chr(10)),
                           lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
        from texts),
    windows as (
        select k, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as s
        from split, unnest(range(1, len(w) - 1)) as u(i)),
    repeated as (
        select k, i from windows
        qualify count(*) over (partition by k, s) > 1),
    covered as (
        select k, count(distinct i + o) as n
        from repeated, (values (0), (1), (2)) as v(o) group by k),
    judged_lines as (
        select k, x, len({_WORDS.format(text="x")}) as n,
               length(regexp_replace(x, '[\x20\x09-\x0D]+', '', 'g')) as solid,
               length(regexp_replace(x, '[^#*$%&<>{{}}\\~^=]', '', 'g')) as symbols,
               length(regexp_replace(x, '[^\pL]', '', 'g')) as letters,
               length(regexp_replace(x, '[^\p{{Lu}}]', '', 'g')) as capitals,
               len(string_split_regex(x, '\s[|»›•>·]\s|\s::\s')) as parts
        from split, unnest(lines) as u(x)),
    left_over as (
        select k, sum(solid) as kept_chars from judged_lines
        where not (parts >= 4
                   or (regexp_matches(lower(x), '{_FURNITURE}') and n <= 12)
                   or 100 * symbols > 10 * solid
                   or (100 * capitals > 70 * letters and letters >= 20)
                   or (n < 3 and not regexp_matches(
                       x, '[.!?:;…。！？"''”’)\]][\x20\x09-\x0D]*$')))
        group by k),
    counted as (
        select split.*, len(w) as n_words,
               length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) as word_chars,
               length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols,
               len(lines) - len(list_distinct(lines)) as n_dup_lines,
               coalesce(n, 0) as n_repeat_words, coalesce(kept_chars, 0) as kept_chars
        from split left join covered using (k) left join left_over using (k)),
    failed as (
        select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed
        from counted)
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           not base_failed and 100 * kept_chars >= 50 * greatest(word_chars, 1) as kept
    from failed"""

# crc32 of a list of bytes, looked up byte by byte in the table of its polynomial.
_CRC_TABLE = """
    crc_bits(i, k, c) as (
        select i, 0, i from range(256) as t(i)
        union all
        select i, k + 1, case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end
        from crc_bits where k < 8),
    crc_table as (select list(c order by i) as t from crc_bits where k = 8)"""
_CRC = """xor(4294967295, list_reduce(
    list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: ('0x' || x)::bigint),
    lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295::bigint))"""

OP11 = rf"""
    with recursive {_CRC_TABLE},
    runs as (
        select coalesce(doc_id::varchar, '') as id,
               unnest(regexp_extract_all({_LOWER_AZ.format(text="text")}, '[a-z\x{{C0}}-\x{{FF}}]+')) as r
        from documents),
    hashed as (
        select r, times, {_CRC.format(text="id || ':' || r")} as h
        from (select id, r, count(*) as times from runs group by id, r), crc_table),
    results as (
        select case when h % 97 = 0
                    then substr(r, 1, h % length(r)) || substr(r, h % length(r) + 2)
                    else r end as word, times
        from hashed),
    words as materialized (
        select word, sum(times)::bigint as n from results
        where length(word) >= 5 group by word having sum(times) >= 3),
    less as materialized (
        select word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) as rest
        from words, unnest(range(1, length(word) + 1)) as u(i)),
    near as (
        select a.word, b.word as other, b.n from less a join less b
            on a.rest = b.rest and a.i = b.i and a.word <> b.word and length(a.word) = length(b.word)
        union
        select a.word, b.word, b.n from less a join words b on a.rest = b.word
        union
        select b.word, a.word, a.n from less a join words b on a.rest = b.word),
    best as (
        select word, count(*) as n_near, max(n) as best_n from near group by word),
    smallest as (
        select word, n_near, best_n, min(other collate "C") as best
        from best join near using (word) where near.n = best_n group by all),
    forms as materialized (
        select words.word, words.n, coalesce(n_near, 0) as n_near,
               case when best_n >= 2 * words.n then best end as form,
               case when best_n >= 2 * words.n then best_n end as form_n
        from words left join smallest using (word)),
    chains(word, reached, steps) as (
        select word, word, 0 from forms
        union all
        select c.word, f.form, steps + 1 from chains c join forms f on f.word = c.reached
        where f.form is not null)
    select forms.*, root
    from forms join (select word, max_by(reached, steps) as root from chains group by word) using (word)"""

OP12 = rf"""
    with pieces as (
        select coalesce(lang, 'und') as lang,
               unnest(regexp_extract_all({_LOWER_AZ.format(text="text")},
                                         '[^.,;:!?\x0A-\x0D]+')) as piece
        from documents),
    split as (
        select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
    totals as (select lang, sum(len(w))::bigint as n from split group by lang),
    grams as (
        select lang, m, unnest(list_transform(range(1, len(w) - m + 2),
                                              lambda i: w[i:i + m - 1])) as p
        from split, range(1, 5) as u(m)),
    f as materialized (
        select lang, m, p, array_to_string(p, ' ') as phrase, count(*) as a
        from grams group by lang, m, p having count(*) >= 30),
    cuts as (
        select lang, m, phrase, a, k, array_to_string(p[:k], ' ') as head,
               array_to_string(p[k + 1:], ' ') as tail
        from f, range(1, 4) as u(k) where k < m),
    scored as (
        select c.*, l.a as l, r.a as r, (2000000::hugeint * c.a // (l.a + r.a))::bigint as score
        from cuts c join f l on l.lang = c.lang and l.phrase = c.head
                    join f r on r.lang = c.lang and r.phrase = c.tail
        qualify row_number() over (partition by c.lang, c.phrase order by score, k) = 1),
    parts as (
        select lang, a, unnest(list_transform(
                   range(1, m - j + 2), lambda i: array_to_string(p[i:i + j - 1], ' '))) as phrase
        from f, range(2, 4) as v(j) where j < m),
    longest as (select lang, phrase, max(a) as longer from parts group by lang, phrase),
    survivors as (
        select scored.* from scored left join longest using (lang, phrase)
        where coalesce(100 * longer < 80 * a, true)),
    ranked as (
        select *, row_number() over (partition by lang order by score desc, a desc,
                                     phrase collate "C") as rank
        from survivors)
    select lang, rank, phrase, a, l, r, n, score
    from ranked join totals using (lang) where rank <= 2000"""

OP13 = f"""
    with recursive {_CRC_TABLE},
    texts as (
        select row_number() over () as k, doc_id, coalesce(text, '') as text from documents),
    keyed as (
        select k, doc_id, strlen(text) + 1 as size, {_CRC.format(text="text")} as text_crc32,
               ('0x' || substr(md5(text), 1, 15))::bigint as key
        from texts, crc_table),
    summed as (
        select *, sum(size) over (order by key, doc_id nulls first, k
                                  rows unbounded preceding) as upto,
               sum(size) over () as total,
               row_number() over (order by key, doc_id nulls first, k) as place
        from keyed),
    placed as (
        select *, least(7, (2 * upto - size) * 8 // (2 * total))::int as shard from summed)
    select doc_id, size, text_crc32, 'bytes' as law, shard,
           place - min(place) over (partition by shard) as slot, null::int as grown_shard
    from placed"""

SQL = {
    "op1_url_filter": OP1,
    "op3_minhash_near_dedup": OP3,
    "op8_quality_rules": OP8,
    "op11_spelling_variants": OP11,
    "op12_phrase_collocations": OP12,
    "op13_sharding": OP13,
}
