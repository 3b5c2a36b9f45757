"""DuckDB SQL for the queries that SQL can express.

Written apart from the Spark code, with windows and joins of its own; only
parameters (targets' powers, seeds, template texts) are taken from there.
"""

from creditweave.llm import licenses, mixing

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

EXACT = f"""
    with t as (select doc_id, sha256({LOWER}) as text_sha256 from documents)
    select doc_id, max(doc_id) over g as keep_id, count(*) over g as group_size,
        doc_id = max(doc_id) over g as kept, text_sha256
    from t window g as (partition by text_sha256)
"""


def mixing_sql(sweeps: int = mixing.SWEEPS) -> str:
    parts = [
        r"""with d as (
            select doc_id, coalesce(source, 'unknown') as source, coalesce(lang, 'und') as lang,
                coalesce(text, '') as body, len(regexp_extract_all(coalesce(text, ''), '[^ \t-\r]+')) as n_tokens
            from documents),
        f as (
            select doc_id, source, lang, n_tokens,
                case when contains(body, ' | ') then 'table'
                    when len(regexp_extract_all(body, '[!-/:-@\[-`{-~]')) * 12 > length(body) then 'symbols'
                    when n_tokens < 100 then 'short' when n_tokens >= 1000 then 'long' else 'prose' end as topic
            from d)""",
        "c0 as (select source, lang, topic, sum(n_tokens) as tokens, sum(n_tokens)::double as w from f"
        " group by all having sum(n_tokens) > 0)",
    ]
    for m in mixing.MARGINS:
        parts.append(
            f"t_{m} as (select {m}, pow(sum(tokens), {mixing.TEMPERATURE[m]})"
            f" / sum(pow(sum(tokens), {mixing.TEMPERATURE[m]})) over () * sum(sum(tokens)) over () as target from c0 group by {m})"
        )
    step = 0
    for _ in range(sweeps):
        for m in mixing.MARGINS:
            parts.append(
                f"c{step + 1} as materialized (select source, lang, topic, tokens,"
                f" w * target / sum(w) over (partition by {m}) as w from c{step} join t_{m} using ({m}))"
            )
            step += 1
    draw = f"('0x' || substr(md5('{mixing.SEED}:' || coalesce(doc_id::varchar, 'null')), 1, 8))::ubigint / 4294967296.0"
    return ",\n".join(parts) + f"""
        select doc_id, source, lang, topic, n_tokens, round(r, 9) as ratio, round(least(1.0, r), 9) as probability,
            round(r / least(1.0, r), 9) as weight, {draw} < least(1.0, r) as kept
        from (select f.*, coalesce(w / tokens, 1.0) as r from f left join c{step} using (source, lang, topic))"""


def licenses_sql() -> str:
    rows = ", ".join(
        "('{}', '{}', {})".format(name, " ".join(licenses.words_of(text)), i)
        for i, (name, text) in enumerate((n, t) for n, ts in licenses.TEMPLATES.items() for t in ts)
    )
    t, low = licenses.THRESHOLD, licenses.LEAST_BIGRAMS

    def bigrams(source: str, keys: str) -> str:
        return f"""
            select {keys}, w, v, count(*) as n from (
                select {keys}, w, lead(w) over (partition by {keys} order by i) as v
                from (select {keys}, unnest(words) as w, generate_subscripts(words, 1) as i from {source}))
            where v is not null group by all"""

    return rf"""
        with template(name, body, tid) as (values {rows}),
        t as (select name, tid, string_split(body, ' ') as words, len(words) - 1 as size from template
            where len(string_split(body, ' ')) > {low}),
        d as (select doc_id, regexp_replace({LOWER}, '[^a-z0-9\n]+', ' ', 'g') as plain from documents),
        u as (select doc_id, unnest(list_distinct(list_concat(string_split(plain, chr(10)),
            regexp_split_to_array(plain, '\n ?\n[\n ]*'), [plain]))) as unit from d),
        w as (select doc_id, unit, regexp_extract_all(unit, '[a-z0-9]+') as words from u),
        fit as (
            select doc_id, row_number() over () as uid, words, len(words) - 1 as size from w
            where exists (select 1 from t where least(t.size, len(w.words) - 1) * {2 - t} + 1e-9 >= greatest(t.size, len(w.words) - 1) * {t})
            and len(words) > 1),
        pairs as ({bigrams("fit", "uid")}),
        wanted as ({bigrams("t", "tid")}),
        common as (select uid, tid, sum(least(p.n, q.n)) as n from pairs p join wanted q using (w, v) group by all),
        rated as (select doc_id, uid, name, 2.0 * n / (fit.size + t.size) as dice
            from common join fit using (uid) join t using (tid) where 2.0 * n / (fit.size + t.size) >= {t}),
        best as (select doc_id, count(distinct uid) as m, max(dice) as dice, arg_min(name, (-dice, name)) as license from rated group by doc_id),
        n as (select doc_id, count(*) as n from fit group by doc_id)
        select d.doc_id, coalesce(n.n, 0) as n_candidates, coalesce(m, 0) as n_matches, license,
            coalesce(round(dice, 9), 0.0) as dice
        from d left join n using (doc_id) left join best using (doc_id)"""


FILL_MIDDLE = r"""
    with d as (
        select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') as units,
            sha256('7:' || coalesce(doc_id::varchar, 'null')) as s
        from documents),
    h as (
        select *, len(units) as n, ('0x' || s[1:8])::ubigint as h1, ('0x' || s[9:16])::ubigint as h2,
            ('0x' || s[17:24])::ubigint as h3, ('0x' || s[25:32])::ubigint as h4
        from d),
    cut as (
        select *, least(h1 % (n + 1), h2 % (n + 1))::bigint as a, greatest(h1 % (n + 1), h2 % (n + 1))::bigint as b,
            case when t = '' or regexp_matches(t, '<[PSM]>') or h3 % 100 >= 100 then 'plain'
                when h4 % 100 < 50 then 'spm' else 'psm' end as form
        from h),
    parts as (
        select *, array_to_string(units[:a], '') as p, array_to_string(units[a + 1:b], '') as m,
            array_to_string(units[b + 1:], '') as x
        from cut)
    select doc_id, n::bigint as n, form, case when form <> 'plain' then length(p) end as prefix_chars,
        case when form <> 'plain' then length(m) end as middle_chars,
        sha256(case form when 'plain' then t when 'psm' then concat('<P>', p, '<S>', x, '<M>', m)
            else concat('<S>', x, '<P>', p, '<M>', m) end) as output_sha256,
        sha256(case form when 'plain' then t else concat(p, m, x) end) as restored_sha256
    from parts"""

# The longest passage is the longest run of occurrences in step with an item.
DECONTAMINATE = r"""
    with dw as (
        select row_number() over () as uid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
        from documents),
    iw as (
        select row_number() over () as iid, coalesce(item_id::varchar, 'null') as item, regexp_extract_all(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
        from benchmark),
    win as (
        select iid, item, j, least(10, len(w)) as n, array_to_string(w[j:j + 9], ' ') as gram
        from (select *, unnest(range(1, greatest(2, len(w) - 8))) as j from iw where len(w) > 0)),
    grams as (
        select uid, i, n, array_to_string(w[i:i + n - 1], ' ') as gram
        from (select uid, w, n, unnest(range(1, len(w) - n + 2)) as i
            from dw, (select distinct n from win) where len(w) >= n)),
    met as (select uid, i, g.n, iid, item, j from grams g join win using (n, gram)),
    hits as (
        select uid, count(distinct p) as n_hit from (select uid, unnest(range(i, i + n)) as p from (select distinct uid, i, n from met))
        group by uid),
    found as (
        select uid, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as items from met group by uid),
    runs as (
        select uid, max(i) - min(i) + max(n) as words
        from (select *, i - row_number() over (partition by uid, iid, i - j order by i) as run from met)
        group by uid, iid, i - j, run),
    longest as (select uid, max(words) as longest from runs group by uid)
    select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
        sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated, coalesce(longest, 0)::bigint as longest
    from dw left join hits using (uid) left join found using (uid) left join longest using (uid)"""


ORACLES = {
    "op1_exact_dedup": EXACT,
    "op3_mixing": mixing_sql(),
    "op9_licenses": licenses_sql(),
    "op11_fill_middle": FILL_MIDDLE,
    "op12_decontaminate": DECONTAMINATE,
}
