"""The registered queries as DuckDB SQL over the same tables."""

from __future__ import annotations

from creditweave.operators.audit import FORBIDDEN_VERBS
from creditweave.operators.marts import HISTORY
from creditweave.operators.scorecard import DEFAULT_SCORECARD
from creditweave.plans.catalogue import CATALOGUE
from creditweave.plans.registry import DRAFTS, FIXED_TREES, LOADED_UNTIL, TOP_DECLINES
from creditweave.settings import CATEGORICAL, FEATURES, NUMERIC_FEATURES
from creditweave.sources import schemas
from creditweave.sources.tables import LABELS


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def double(value: float) -> str:
    return f"cast({value!r} as double)"


def rounded(expression: str, digits: int = 6) -> str:
    scale = double(float(10**digits))
    return f"(round_even(({expression}) * {scale}, 0) / {scale})"


STAGED_APPLICATIONS = f"""
    select
        o_orderkey as application_id,
        cast(case when o_orderstatus = 'F' then 1 else 0 end as integer) as is_default,
        o_orderpriority as contract_type,
        case when c_nationkey % 2 = 0 then 'F' else 'M' end as gender,
        case when o_custkey % 3 = 0 then 'Y' else 'N' end as owns_car,
        case when o_custkey % 2 = 0 then 'Y' else 'N' end as owns_realty,
        cast(c_nationkey % 4 as integer) as children_count,
        case when o_custkey % 50 = 0 then cast(0 as double) else c_acctbal end as income_total,
        o_totalprice as credit_amount,
        {rounded("o_totalprice * " + double(0.05), 2)} as annuity_amount,
        o_totalprice as goods_price,
        c_mktsegment as income_type,
        case when o_custkey % 4 = 0 then 'higher' else 'secondary' end as education_type,
        case when o_custkey % 5 < 3 then 'married' else 'single' end as family_status,
        cast(trunc((7000 + (o_custkey * 37) % 18000) / {double(365.25)}) as integer) as age_years,
        case
            when o_custkey % 10 = 0 then null
            else round(((o_custkey * 13) % 12000) / {double(365.25)}, 6)
        end as employment_years
    from orders
    join customer on o_custkey = c_custkey
"""

CENTS = "cast(floor({} * 100 + cast(0.5 as double)) as bigint)"
PRICE, DISCOUNT, TAX = (CENTS.format(c) for c in ("l_extendedprice", "l_discount", "l_tax"))
DAY = "cast(date_diff('day', date '2002-01-01', cast({} as date)) as integer)"

STAGED_CREDITS = f"""
    select
        l_orderkey as application_id,
        md5(concat_ws('|', l_orderkey, l_suppkey, l_linenumber, cast(l_shipdate as date), l_extendedprice))
            as bureau_credit_id,
        case when l_linestatus = 'O' then 'Active' else 'Closed' end as credit_status,
        l_returnflag as credit_type,
        -{DAY.format("l_shipdate")} as days_since_credit_opened,
        cast(case when l_returnflag = 'R' then l_quantity else 0 end as integer) as days_overdue,
        l_extendedprice as credit_sum,
        {PRICE} * (100 - {DISCOUNT}) / {double(10000.0)} as credit_debt,
        case
            when l_returnflag = 'R' then {PRICE} * {DISCOUNT} / {double(10000.0)}
            else cast(0 as double)
        end as credit_overdue
    from lineitem
"""

STAGED_PAYMENTS = f"""
    select
        md5(
            l_orderkey || '||' || l_suppkey || '||' || l_linenumber || '||' || payment_entry_day
            || '||' || l_extendedprice
        ) as payment_id,
        l_orderkey as prior_credit_id,
        l_orderkey as application_id,
        cast(l_suppkey as integer) as installment_version,
        l_linenumber as installment_number,
        installment_due_day,
        payment_entry_day,
        installment_amount,
        l_extendedprice as payment_amount,
        installment_amount - l_extendedprice as payment_shortfall,
        payment_entry_day - installment_due_day as days_late
    from (
        select
            *,
            cast({DAY.format("o_orderdate")} + 60 as integer) as installment_due_day,
            {DAY.format("l_shipdate")} as payment_entry_day,
            floor(({PRICE} * (100 + {TAX}) + 50) / {double(100.0)}) / {double(100.0)} as installment_amount
        from lineitem
        join orders on l_orderkey = o_orderkey
    )
"""

ROLLUP = """
    select
        application_id,
        count(*) as prior_credit_count,
        count(*) filter (where credit_status = 'Active') as active_credit_count,
        cast(sum(cast(credit_debt as decimal(18, 4))) as double) as total_credit_debt,
        cast(sum(cast(credit_overdue as decimal(18, 4))) as double) as total_credit_overdue,
        max(days_overdue) as max_days_overdue
    from stage_credits
    group by application_id
"""

_HISTORY = ", ".join(f"coalesce({c}, 0) as {c}" for c in HISTORY)
_RATIOS = ", ".join(
    f"case when income_total <> 0 then {c}_amount / income_total end as {c}_to_income_ratio" for c in ("credit", "annuity")
)
MART = f"""
    select
        application_id, is_default, contract_type, income_total, credit_amount,
        annuity_amount, age_years, employment_years, {_HISTORY}, {_RATIOS}
    from stage_applications left join credit_rollup using (application_id)
"""


def _term(feature: str) -> str:
    card = DEFAULT_SCORECARD
    if feature == CATEGORICAL:
        cases = " ".join(f"when {text(c)} then {double(w)}" for c, w in card.categories.items())
        return f"case contract_type {cases} else cast(0 as double) end"
    center, scale, weight = (double(v) for v in card.numeric[feature])
    return f"{weight} * ((coalesce({feature}, {center}) - {center}) / {scale})"


TERMS = (
    "select *, "
    + ", ".join(f"{_term(f)} as t_{f}" for f in FEATURES)
    + " from applicant_features"
)
_MARGIN = " + ".join([double(DEFAULT_SCORECARD.intercept), *[f"t_{f}" for f in FEATURES]])
SCORES = f"""
    select
        * exclude ({", ".join(f"t_{f}" for f in FEATURES)}),
        1 / (1 + exp(-({_MARGIN}))) as predicted_pd,
        {", ".join(f"t_{f} as term_{f}" for f in FEATURES)}
    from terms
"""


def shown(source: str, columns: list[str]) -> str:
    """``source`` with six decimals in ``columns``: figures are rounded for readers only."""
    parts = ", ".join(f"{rounded(c)} + cast(0 as double) as {c}" for c in columns)
    return f"select * replace ({parts}) from ({source})"


PD = ["predicted_pd"]
DRIVERS = [*PD, "top1_shap", "top2_shap", "top3_shap"]
_TERM_NAMES = [f"term_{f}" for f in FEATURES]
LINEAR_SCORES = shown(f"select application_id, predicted_pd, {', '.join(_TERM_NAMES)} from scores", [*PD, *_TERM_NAMES])

_POSITIONS = ", ".join(f"({i}, {text(f)})" for i, f in enumerate(FEATURES))
_PICKED = " ".join(f"when {i} then term_{f}" for i, f in enumerate(FEATURES))
_TOPS = ", ".join(
    f"max(feature) filter (where place = {i}) as top{i}_feature, max(term) filter (where place = {i}) as top{i}_shap"
    for i in (1, 2, 3)
)
PREDICTIONS = f"""
    select application_id, any_value(predicted_pd) as predicted_pd, {_TOPS}
    from (
        select
            *, row_number() over (partition by application_id order by term desc, position) as place
        from (
            select application_id, predicted_pd, position, feature, case position {_PICKED} end as term
            from scores cross join (values {_POSITIONS}) as p(position, feature)
        )
    )
    where place <= 3
    group by application_id
"""
SCORED = "select * from applicant_features join stage_predictions using (application_id)"
LABEL_ROWS = ", ".join(f"({text(f)}, {text(label)})" for f, label in LABELS.items())


_LABELLED = ", ".join(
    f"(select feature_label from feature_labels where feature_name = top{i}_feature) as top{i}_label" for i in (1, 2, 3)
)


def _declined(cap: str) -> str:
    return f"""
    with ranked as (
        select *, rank() over (order by predicted_pd desc, application_id) as decline_rank
        from stage_predictions where predicted_pd >= 0.30
    ),
    labelled as (select *, {_LABELLED} from ranked where decline_rank {cap})
    select *, format('1. {{}}; 2. {{}}; 3. {{}}', top1_label, top2_label, top3_label) as driver_list from labelled
    """


REASONS = """
    select
        * exclude (top1_shap, top2_shap, top3_shap),
        'We could not approve your loan. What weighed most was ' || top1_label || ', followed by '
        || top2_label || ' and ' || top3_label || '.' as adverse_action_reason
    from declined
"""
PROMPTS = """
    select
        application_id, decline_rank,
        'Write two or three polite sentences that tell a loan applicant why the application was turned down. '
        || 'Use these factors only, word for word, and no other factor, figure or score: ' || driver_list
        || '. Make no promise about later decisions and add nothing of your own.' as prompt
    from declined
"""
# Every phrase a reason holds, and whether it is one of the applicant's own.
CITATIONS = r"""
    select
        application_id, feature_label as phrase,
        list_contains([top1_label, top2_label, top3_label], feature_label) as own
    from (
        select *, lower(adverse_action_reason || case application_id % 5
            when 0 then ' We also noted applicant age.'
            when 1 then ' We do not rank applicant ages.'
            else '' end) as reason
        from decline_reasons
    )
    join feature_labels on regexp_matches(reason, '\b' || feature_label || '\b')
"""
UNGROUNDED = "select application_id, phrase as foreign_label_cited from citations where not own"
GROUNDING = """
    with per_reason as (
        select
            r.application_id,
            count(*) filter (where own) as own_phrases,
            count(*) filter (where not own) as other_phrases
        from decline_reasons as r left join citations as c on r.application_id = c.application_id
        group by r.application_id
    )
    select
        count(*) as n_reasons,
        round(avg(own_phrases), 2) as avg_own_drivers_cited,
        count(*) filter (where own_phrases > 0) as reasons_citing_any_driver,
        count(*) filter (where other_phrases > 0) as reasons_with_foreign_factor
    from per_reason
"""

# -- payments --------------------------------------------------------------

FIRST_LOAD = f"select * from stage_payments where installment_due_day <= {LOADED_UNTIL}"
CORRECTED = f"""
    select
        payment_id, prior_credit_id, application_id, installment_version, installment_number,
        due as installment_due_day, payment_entry_day, owed as installment_amount, payment_amount,
        owed - payment_amount as payment_shortfall, payment_entry_day - due as days_late
    from (
        select
            *,
            cast(installment_due_day + case
                when prior_credit_id % 11 = 0 and installment_due_day < {LOADED_UNTIL} then 1500 else 0
            end as integer) as due,
            installment_amount + case when prior_credit_id % 3 = 0 then 1 else 0 end as owed
        from stage_payments
    )
"""
BATCH = """
    select * from corrected
    where installment_due_day >= (select max(installment_due_day) from first_load)
"""
MERGED = """
    select * from first_load where payment_id not in (select payment_id from batch)
    union all
    select * from batch
"""

# -- metrics ---------------------------------------------------------------


def _auc(by: str = "") -> str:
    """Area by mean ranks."""
    over = f"partition by {by} order by predicted_pd" if by else "order by predicted_pd"
    ties = f"{by}, predicted_pd" if by else "predicted_pd"
    return f"""
        select
            *,
            rank() over ({over}) + (count(*) over (partition by {ties}) - 1) / cast(2 as double) as mid_rank
        from scores
    """


_AUC_VALUE = rounded(
    "(sum(mid_rank) filter (where is_default = 1)"
    " - count(*) filter (where is_default = 1) * (count(*) filter (where is_default = 1) + 1) / cast(2 as double))"
    " / (count(*) filter (where is_default = 1) * cast(count(*) filter (where is_default = 0) as double))"
)
AUC = f"select {_AUC_VALUE} as auc from ({_auc()})"
KS = f"""
    select {rounded("max(abs(hits - misses))")} as ks
    from (
        select
            sum(case when is_default = 1 then 1 else 0 end) over upto
            / cast(sum(case when is_default = 1 then 1 else 0 end) over () as double) as hits,
            sum(case when is_default = 0 then 1 else 0 end) over upto
            / cast(sum(case when is_default = 0 then 1 else 0 end) over () as double) as misses
        from scores
        window upto as (order by predicted_pd range between unbounded preceding and current row)
    )
"""
BRIER = f"select {rounded('avg((predicted_pd - is_default) * (predicted_pd - is_default))')} as brier_raw from scores"
_EDGES = ", ".join(f"quantile_cont(predicted_pd, {k / 10}) as e{k}" for k in range(1, 10))
_BIN = " + ".join(f"cast(predicted_pd > e{k} as integer)" for k in range(1, 10))
RELIABILITY = f"""
    select
        bin, count(*) as n,
        {rounded("avg(predicted_pd)")} as mean_predicted,
        {rounded("avg(is_default)")} as observed_rate
    from (
        select predicted_pd, is_default, {_BIN} as bin
        from scores cross join (select {_EDGES} from scores)
    )
    group by bin
"""
SLICES = f"""
    select
        contract_type, count(*) as n,
        {rounded("avg(is_default)")} as observed_rate,
        {rounded("avg(predicted_pd)")} as mean_predicted,
        {_AUC_VALUE} as auc
    from ({_auc("contract_type")})
    group by contract_type
"""
METRIC_LOG = f"""
    select 'run-1' as run_id, 'training' as stage, 'auc' as metric, auc as value from ({AUC})
    union all
    select 'run-1', 'training', 'ks', ks from ({KS})
    union all
    select 'run-1', 'calibration', 'brier_raw', brier_raw from ({BRIER})
"""


def _split(source: str, share: float, salt: str, flag: str) -> str:
    """Exact stratified selection by hash order."""
    return f"""
        select * exclude (place, n, wanted, exact, spare, quota_place), place <= floor(exact)
            + case when quota_place <= spare then 1 else 0 end as {flag}
        from (
            select r.*, q.* exclude (stratum)
            from (
                select *, row_number() over (
                    partition by is_default order by md5(application_id || '|{salt}'), application_id
                ) as place
                from {source}
            ) as r
            join (
                select
                    *, wanted - sum(floor(exact)) over () as spare,
                    row_number() over (order by exact - floor(exact) desc, stratum) as quota_place
                from (
                    select
                        is_default as stratum, count(*) as n,
                        ceil({double(share)} * sum(count(*)) over ()) as wanted,
                        wanted * count(*) / sum(count(*)) over () as exact
                    from {source}
                    group by is_default
                )
            ) as q on r.is_default = q.stratum
        )
    """


def _folds(source: str) -> str:
    return f"""
    with tested as ({_split(source, 0.2, "holdout-42", "in_test")}),
    held as (select * from tested where in_test),
    halved as ({_split("held", 0.5, "evaluation-42", "in_eval")})
    select t.*, case
        when h.in_eval then 'evaluation' when t.in_test then 'calibration' else 'train'
    end as fold
    from tested as t left join halved as h on t.application_id = h.application_id
    """


HASH_SPLIT = f"select application_id, is_default, fold from ({_folds('stage_applications')})"

# Isotonic fit by the max-min formula over all runs of adjacent scores; between
# fitted scores the map is linear, beyond them constant.
ISOTONIC = f"""
    with folds as materialized ({_folds("scores")}),
    points as materialized (
        select
            row_number() over (order by predicted_pd) as i, predicted_pd as x,
            sum(count(*)) over (order by predicted_pd) as w,
            sum(sum(is_default)) over (order by predicted_pd) as y
        from folds where fold = 'calibration' group by predicted_pd
    ),
    runs as (
        select a.i as a, b.i as b, (b.y - coalesce(p.y, 0)) / cast(b.w - coalesce(p.w, 0) as double) as mean
        from points as a join points as b on b.i >= a.i left join points as p on p.i = a.i - 1
    ),
    fitted as materialized (
        select x, max(least_after) as y
        from (
            select a, b, min(mean) over (
                partition by a order by b rows between current row and unbounded following
            ) as least_after
            from runs
        ) join points on b = i
        group by x
    ),
    placed as (
        select f.application_id, f.predicted_pd, f.is_default, f.contract_type, l.x as x0, l.y as y0, u.x as x1, u.y as y1
        from (select * from folds where fold = 'evaluation') as f
        asof left join fitted as l on f.predicted_pd >= l.x
        asof left join fitted as u on f.predicted_pd <= u.x
    )
    select
        application_id, predicted_pd, is_default, contract_type,
        case when x0 is null then y1 when x1 is null or x0 = x1 then y0
            else y0 + (y1 - y0) * (predicted_pd - x0) / (x1 - x0) end as calibrated_pd
    from placed
"""
_SQUARED = "avg(({0} - is_default) * ({0} - is_default))"
VERDICT = f"""
    select *, case when brier_calibrated < brier_raw then 'better' else 'worse' end as verdict
    from (
        select
            {rounded(_SQUARED.format("predicted_pd"))} as brier_raw,
            {rounded(_SQUARED.format("calibrated_pd"))} as brier_calibrated
        from ({ISOTONIC})
    )
"""

# -- checks ----------------------------------------------------------------

FAULTY = """
    select
        application_id,
        case when application_id % 97 = 0 then null else income_total end as income_total,
        case when application_id % 101 = 0 then null when application_id % 89 = 0 then 2 else is_default end
            as is_default,
        case when application_id % 83 = 0 then -1000 when application_id % 79 = 0 then 100.5
            else employment_years end as employment_years
    from stage_applications
"""
CONTRACT = """
    select 'application_id' as column_name, 'bigint' as expected_type, 'int' as actual_type,
        count(*) as values_affected from applicant_features
    union all
    select 'employment_years', 'double', null, count(*) from applicant_features
    union all
    select 'load_note', null, 'string', count(*) filter (where application_id % 2 = 0) from applicant_features
"""

# -- drafted SQL -------------------------------------------------------------


def _draft(draft: str) -> str:
    parts = " || replace(text, chr(39), chr(39) || chr(39)) || ".join(text(p) for p in draft.split("{text}"))
    return parts.replace("\n", "' || chr(10) || '")


TURNS = "select conv_id || '-' || turn as question_id, conv_id * 7 + turn as k, text from conversations"
_DRAFTS = " ".join(f"when {i} then {_draft(d)}" for i, d in enumerate(DRAFTS))
_VERB = "case " + " ".join(rf"when regexp_matches(l, '\b{v}\b') then '{v}'" for v in FORBIDDEN_VERBS) + " end"
_ALLOWED = ", ".join(text(t) for t in schemas.CONTRACTS)
AUDIT = rf"""
    with drafts as (
        select question_id, trim(case k % {len(DRAFTS)} {_DRAFTS} end, ' ' || chr(10)) as raw
        from ({TURNS})
    ),
    cleaned as (
        select question_id, trim(rtrim(trim(
            regexp_replace(raw, '(?is)^```(?:sql)?\s*(.*?)\s*```$', '\1'), ' ' || chr(10)), ';'), ' ' || chr(10)
        ) as cleaned_sql
        from drafts
    ),
    facts as (
        select
            question_id, cleaned_sql, lower(cleaned_sql) as l, {_VERB} as verb,
            list_sort(list_distinct(list_filter(
                regexp_extract_all(lower(cleaned_sql), '\b(?:from|join)\s+([a-zA-Z0-9_.]+)', 1),
                lambda t: split_part(t, '.', -1) not in ({_ALLOWED})
            )))[1] as foreign_table
        from cleaned
    ),
    gated as (
        select question_id, cleaned_sql, verb, foreign_table, case
            when contains(cleaned_sql, ';') then 'single_statement'
            when not regexp_matches(l, '^\s*(select|with)\b') then 'read_only'
            when verb is not null then 'forbidden_verb'
            when foreign_table is not null then 'table_allowlist'
            when regexp_matches(l, '\b(?:from|join)\s+[`"]')
                or regexp_matches(l, '\bfrom\s+[a-z0-9_.]+(?:\s+(?:as\s+)?[a-z0-9_]+)?\s*,') then 'hidden_table'
        end as gate
        from facts
    )
    select
        question_id, case when gate is null then 'accepted' else 'refused' end as verdict, gate,
        case gate when 'forbidden_verb' then verb when 'table_allowlist' then foreign_table end as detail,
        cleaned_sql
    from gated
"""
ANSWERS = f"""
    select
        question_id,
        case when k % 7 < 3 then length(text) || '.5' else text end as expected,
        case k % 7
            when 0 then length(text) || '.50'
            when 1 then length(text) || '.50005'
            when 2 then length(text) || '.5002'
            when 3 then '  ' || text || ' '
            when 4 then text || ' not'
            when 5 then text
        end as got,
        k % 7 in (0, 1, 3) as hit
    from ({TURNS})
"""

_TABLE_ROWS = {
    "applications": "applicant_features",
    "payments": "stage_payments",
    "scored": "scored_applicants",
    "declines": "declined",
}
_COMMENT_ROWS = ", ".join(
    f"({text(table)}, {text(column)}, {text(comment)})"
    for table in schemas.CONTRACTS
    for column, comment in [("", schemas.TABLE_DESCRIPTIONS[table])]
    + list(schemas.DESCRIPTIONS[table].items())
)
_COUNTED = " ".join(f"when {text(t)} then (select count(*) from {source})" for t, source in _TABLE_ROWS.items())
COMMENTS = f"""
    select table_name, column_name, comment, case table_name {_COUNTED} end as n_rows
    from (values {_COMMENT_ROWS}) as c(table_name, column_name, comment)
"""

# Tables that other queries build on, in order.
STEPS = {
    "stage_applications": STAGED_APPLICATIONS,
    "stage_credits": STAGED_CREDITS,
    "stage_payments": STAGED_PAYMENTS,
    "credit_rollup": ROLLUP,
    "applicant_features": MART,
    "terms": TERMS,
    "scores": SCORES,
    "stage_predictions": PREDICTIONS,
    "scored_applicants": SCORED,
    "feature_labels": f"select * from (values {LABEL_ROWS}) as l(feature_name, feature_label)",
    "declined": _declined("> 0"),
    "decline_reasons": REASONS,
    "citations": CITATIONS,
    "first_load": FIRST_LOAD,
    "corrected": CORRECTED,
    "batch": BATCH,
    "merged": MERGED,
    "faulty": FAULTY,
}

# -- the booster ---------------------------------------------------------------

VALUES_BY_FEATURE = "select application_id, is_default, unnest([{}], recursive := true) from applicant_features".format(
    ", ".join(f"{{'feature': {text(f)}, 'x': cast({f} as double)}}" for f in NUMERIC_FEATURES)
)

# Values by sketch cell, cells by bin.
CELLS = f"""
    with v as ({VALUES_BY_FEATURE}),
    g as (select *, case when abs(x) >= 1e-300 then floor(log2(abs(x))) end as guess from v),
    p as (
        select *, guess + case when pow(2.0, guess) > abs(x) then -1 when pow(2.0, guess + 1) <= abs(x) then 1 else 0 end as power
        from g)
    select feature, case when abs(x) < 1e-300 then 0.0 else floor(x / pow(2.0, power - 7)) * pow(2.0, power - 7) end as low,
        count(*) as n, sum(is_default) as hits
    from p group by all
"""
BINNED_CELLS = f"""
    with placed as (
        select *, sum(n) over (partition by feature order by low) - n as before, sum(n) over (partition by feature) as total
        from ({CELLS}) where low is not null),
    quantiles as (select *, floor(cast(before * 63 as double) / total) as quantile from placed)
    select feature, low, n, hits, cast(dense_rank() over (partition by feature order by quantile) as integer) as bin from quantiles
    union all
    select feature, low, n, hits, 0 from ({CELLS}) where low is null
"""
CATEGORY_BINS = f"""
    select {text(CATEGORICAL)} as feature, {CATEGORICAL} as category, n, hits,
        cast(case when {CATEGORICAL} is null then 0 else row_number() over (order by {CATEGORICAL} is null, n desc, {CATEGORICAL}) end as integer) as bin
    from (select {CATEGORICAL}, count(*) as n, sum(is_default) as hits from applicant_features group by 1)
"""
FEATURE_BINS = f"""
    select feature, bin, min(low) as low_edge, cast(null as varchar) as category, cast(sum(n) as bigint) as n_rows
    from ({BINNED_CELLS}) group by feature, bin
    union all
    select feature, bin, null, category, n from ({CATEGORY_BINS})
"""

# Gradients are whole numbers of 2**-20, as in the fit.
FIRST_SPLIT = f"""
    with base as (
        select 1 / (1 + exp(-ln(sum(is_default) / cast(count(*) - sum(is_default) as double)))) as p from applicant_features),
    unit as (
        select round_even((p - 1) * 1048576, 0) as g1, round_even(p * 1048576, 0) as g0,
            greatest(round_even(p * (1 - p) * 1048576, 0), 1) as h1
        from base),
    bins as (
        select feature, bin, min(low) as edge, null as category, sum(n) as n, sum(hits) as hits from ({BINNED_CELLS}) group by feature, bin
        union all
        select feature, bin, null, category, n, hits from ({CATEGORY_BINS})),
    sums as (
        select feature, bin, edge, category, n, hits * g1 + (n - hits) * g0 as g, n * h1 as h,
            case when feature = {text(CATEGORICAL)} then (hits * g1 + (n - hits) * g0) / (n * h1 + 10.0 * 1048576) else bin end as place
        from bins, unit),
    missing as (select feature, n, g, h from sums where bin = 0 and feature <> {text(CATEGORICAL)}),
    totals as (select feature, sum(n) as n, sum(g) as g, sum(h) as h from sums group by feature),
    upto as (
        select feature, bin, sum(n) over w as n, sum(g) over w as g, sum(h) over w as h,
            lead(edge) over (partition by feature order by place, bin) as threshold,
            array_agg(category) over w as listed
        from sums where bin > 0 or feature = {text(CATEGORICAL)}
        window w as (partition by feature order by place, bin rows unbounded preceding)),
    sides as (
        select feature, bin, n, g, h, threshold, listed, 0 as side from upto
        union all
        select u.feature, bin, u.n + m.n, u.g + m.g, u.h + m.h, threshold, listed, 1 from upto u join missing m using (feature)),
    tried as (
        select s.*, t.n - s.n as rest, s.g / 1048576 as gl, s.h / 1048576 as hl, (t.g - s.g) / 1048576 as gr, (t.h - s.h) / 1048576 as hr,
            t.g / 1048576 as gt, t.h / 1048576 as ht
        from sides s join totals t using (feature) where least(s.n, t.n - s.n) >= 20 and least(s.h, t.h - s.h) >= 1e-3 * 1048576),
    rated as (
        select *, gl * gl / hl + gr * gr / hr - gt * gt / ht as gain, row_number() over (
            partition by feature order by gl * gl / hl + gr * gr / hr - gt * gt / ht desc, side, len(listed)) as place
        from tried)
    select feature, {rounded("gain")} as gain,
        case when feature <> {text(CATEGORICAL)} then coalesce(threshold, cast('inf' as double)) end as threshold,
        case when feature = {text(CATEGORICAL)} then array_to_string(list_sort(list_filter(listed, lambda c: c is not null)), ',') end as categories,
        case when feature = {text(CATEGORICAL)} then list_contains(list_transform(listed, lambda c: c is null), true)
            else side = 1 or (not exists (select 1 from missing m where m.feature = rated.feature) and n > rest) end as missing_left,
        cast(n as bigint) as rows_left, cast(rest as bigint) as rows_right
    from rated where place = 1 and gain > 1e-9
"""


def _node_test(node: tuple, left: bool) -> str:
    """Whether a row goes to this side of a node of ``FIXED_TREES``."""
    _, _, feature, threshold, categories, missing_left, *_ = node
    inside = f"{feature} < {double(threshold)}" if categories is None else f"{feature} in ({', '.join(map(text, categories))})"
    test = f"coalesce({inside}, {str(missing_left).lower()})"
    return test if left else f"not {test}"


def _fixed_leaves() -> list[tuple[float, dict[str, tuple[str, float]]]]:
    """Value of each leaf, and per feature of its path the test of a row and the share of covered rows."""
    nodes, found = {(n[0], n[1]): n for n in FIXED_TREES}, []

    def walk(tree: int, number: int, path: dict[str, tuple[str, float]]) -> None:
        node = nodes[tree, number]
        if node[2] is None:
            found.append((node[8], path))
            return
        for child, left in ((node[6], True), (node[7], False)):
            test, share = path.get(node[2], ("true", 1.0))
            own = f"({test}) and {_node_test(node, left)}", share * (nodes[tree, child][9] / node[9])
            walk(tree, child, {**path, node[2]: own})

    for tree in sorted({t for t, _ in nodes}):
        walk(tree, 0, {})
    return found


LEAVES = _fixed_leaves()
MET = "select application_id, unnest([{}], recursive := true) from applicant_features".format(
    ", ".join(
        f"{{'leaf': {i}, 'value': {double(value)}, 'size': {len(path)}, 'k': {k}, 'feature': {text(f)},"
        f" 'met': cast({test} as double), 'share': {double(share)}}}"
        for i, (value, path) in enumerate(LEAVES)
        for k, (f, (test, share)) in enumerate(path.items())
    )
)
TREE_MARGINS = "select application_id, {} as margin from applicant_features".format(
    " + ".join(
        f"case when {' and '.join(test for test, _ in path.values()) or 'true'} then {double(value)} else 0 end" for value, path in LEAVES
    )
)
TREE_SCORES = f"select application_id, {rounded('1 / (1 + exp(-margin))')} as predicted_pd from ({TREE_MARGINS})"

# Shapley values by their definition: every subset of a leaf's other features.
TREE_DRIVERS = f"""
    with met as materialized ({MET}),
    subsets as (
        select a.application_id, a.leaf, a.feature, a.k, any_value(a.value * (a.met - a.share)) as change, any_value(a.size) as size, mask,
            bit_count(mask) as known, coalesce(product(case when (mask >> b.k) & 1 = 1 then b.met else b.share end) filter (where b.k <> a.k), 1.0) as chance
        from (select *, unnest(range(0, (1 << size))) as mask from met) a join met b using (application_id, leaf)
        where (mask >> a.k) & 1 = 0
        group by a.application_id, a.leaf, a.feature, a.k, mask),
    given as (
        select application_id, feature, sum(change * chance * factorial(known::integer) * factorial((size - known - 1)::integer) / factorial(size)) as shap
        from subsets group by application_id, feature),
    features as (select unnest({FEATURES!r}) as feature, generate_subscripts({FEATURES!r}, 1) as place),
    every as (
        select application_id, f.feature, place, coalesce(shap, 0.0) as shap
        from (select application_id from applicant_features) cross join features f left join given using (application_id, feature)),
    ranked as (
        select *, row_number() over (partition by application_id order by round(shap, 12) desc, place) as rank from every)
    select application_id, s.predicted_pd,
        {", ".join(f"max(feature) filter (where rank = {i}) as top{i}_feature, {rounded(f'max(shap) filter (where rank = {i})')} + 0 as top{i}_shap" for i in (1, 2, 3))}
    from ranked join ({TREE_SCORES}) s using (application_id) where rank <= 3
    group by application_id, s.predicted_pd
"""


# Tables with planted faults, as the catalogue is asked about.
CHECKED = {
    "stage_applications": "select * from faulty",
    "stage_credits": "select * from stage_credits union all select * from stage_credits where application_id % 3 = 0",
    "stage_payments": "select * from stage_payments",
    "stage_predictions": "select * from stage_predictions",
    "credit_rollup": "select * from credit_rollup",
    "drivers": "select * from declined",
    "applications": "select * from applicant_features where application_id % 11 <> 0",
    "payments": "select * from corrected",
    "scored": "select * from scored_applicants",
    "declines": "select * from decline_reasons",
    "labels": f"""
        select feature_name, case when feature_name = 'age_years' then {text(LABELS["income_total"])} else feature_label end as feature_label
        from feature_labels
    """,
}


def _catalogue() -> str:
    parts = []
    for name, declared in CATALOGUE.items():
        tests = [("not_null", c, f"{c} is null") for c in declared.not_null]
        tests += [("accepted_values", c, f"{c} not in ({', '.join(map(str, v))})") for c, v in declared.accepted.items()]
        for c, (low, high) in declared.ranges.items():
            bounds = [f"{c} < {low}"] * (low is not None) + [f"{c} > {high}"] * (high is not None)
            tests.append(("accepted_range", c, " or ".join(bounds)))
        counts = [(check, c, f"(select count(*) from {name}_checked where {test})") for check, c, test in tests]
        counts += [
            ("unique", c, f"(select count(*) from (select {c} from {name}_checked where {c} is not null group by {c} having count(*) > 1))")
            for c in declared.unique
        ]
        counts += [
            ("relationships", c, f"(select count(distinct {c}) from {name}_checked where {c} not in (select {key} from {parent}_checked))")
            for c, (parent, key) in declared.known.items()
        ]
        parts += [f"select {text(name)} as table_name, {text(check)} as check, {text(c)} as column_name, {n} as offending_rows" for check, c, n in counts]
    steps = ", ".join(f"{name}_checked as materialized ({sql})" for name, sql in CHECKED.items())
    return f"with {steps} " + " union all ".join(parts)


FINAL = {
    **{
        name: f"select * from {name}"
        for name in (
            "stage_applications",
            "stage_credits",
            "stage_payments",
            "credit_rollup",
            "applicant_features",
        )
    },
    "stage_predictions": shown("select * from stage_predictions", DRIVERS),
    "prediction_table": shown("select *, (select count(*) from applicant_features) as rows_written from stage_predictions", DRIVERS),
    "scored_applicants": shown("select * from scored_applicants", DRIVERS),
    "declined_drivers": shown(f"select * from declined where decline_rank <= {TOP_DECLINES}", DRIVERS),
    "decline_reasons": shown("select * from decline_reasons", PD),
    "payments_at_moment": "select * from first_load",
    "payment_feed": "select * from stage_payments",
    "payment_feed_corrections": """
        with amended as (
            select * replace (
                cast(installment_due_day + case when prior_credit_id % 5 = 0 then 400 else 0 end as integer) as installment_due_day,
                installment_amount + case when prior_credit_id % 5 = 0 then cast(2 as double)
                    when prior_credit_id % 3 = 0 then cast(1 as double) else cast(0 as double) end as installment_amount)
            from stage_payments)
        select * replace (
            installment_amount - payment_amount as payment_shortfall, payment_entry_day - installment_due_day as days_late),
            true as same_file_by_file
        from amended
    """,
    "batched_reasons": f"""
        select application_id, decline_rank, length(prompt) || ' characters asked: ' || prompt as adverse_action_reason from ({PROMPTS})
    """,
    "label_csv": """
        select feature_name, feature_label, coalesce(n, 0) as n_leading
        from feature_labels left join (
            select top1_feature, count(*) as n from stage_predictions group by top1_feature
        ) on feature_name = top1_feature
    """,
    "sql_view": """
        select contract_type, count(distinct application_id) as n_applications, count(*) as n_credits
        from stage_applications join stage_credits using (application_id) group by contract_type
    """,
    "column_comments": COMMENTS,
    "gated_build": """
        select 'applications is_default accepted' as gate, count(*) as offending_rows
        from stage_applications where application_id % 89 = 0 having count(*) > 0
    """,
    "boosted_scores": TREE_SCORES,
    "boosted_top_drivers": TREE_DRIVERS,
    "boosted_first_split": FIRST_SPLIT,
    "feature_bins": FEATURE_BINS,
    "boosted_facts": """
        select application_id, true as score_in_range, cast(13 as integer) as n_contributions, true as adds_up, true as has_learnt
        from applicant_features
    """,
    "boosted_calibration": f"""
        select application_id, fold, true as is_probability, true as rises, true as brier_kept
        from ({HASH_SPLIT}) where fold = 'evaluation'
    """,
    "payment_watermark_batch": "select * from batch",
    "payment_merge": "select * from merged",
    "payment_upsert": "select * from merged",
    "payments_as_of": "select * from first_load",
    "payment_history": """
        select cast(1 as bigint) as version, count(*) as n_rows from first_load
        union all select 2, count(*) from merged
    """,
    "payment_rerun": """
        select count(*) as rows_before, count(*) as rows_after, cast(0 as bigint) as rows_changed from merged
    """,
    "linear_scores": LINEAR_SCORES,
    "linear_top_drivers": shown("select * from stage_predictions", DRIVERS),
    "declined_drivers_uncapped": shown("select * from declined", DRIVERS),
    "reason_prompts": PROMPTS,
    "ungrounded_citations": UNGROUNDED,
    "grounding_metrics": GROUNDING,
    "portfolio_scalars": """
        select
            round(avg(predicted_pd), 4) as avg_pd,
            count(*) as scored_applications,
            count(*) filter (where predicted_pd > 0.3) as pd_above_030,
            round(max(predicted_pd), 4) as max_pd,
            count(*) filter (where is_default = 1) as actual_defaulters,
            (select count(*) from decline_reasons) as reasons_generated
        from scored_applicants
    """,
    "driver_frequency": """
        select top1_feature, count(*) as n from stage_predictions
        group by top1_feature order by n desc, top1_feature limit 3
    """,
    "scoring_summary": "select count(*) as scored, round(avg(predicted_pd), 4) as mean_pd from stage_predictions",
    "feature_export_summary": """
        select count(*) as n_rows, round(avg(is_default), 4) as default_rate, cast(15 as integer) as n_columns
        from applicant_features
    """,
    "clustered_write": shown("select * from scored_applicants where predicted_pd >= 0.30", DRIVERS),
    "check_not_null": """
        select application_id, 'is_default' as column_name from faulty where is_default is null
        union all select application_id, 'income_total' from faulty where income_total is null
    """,
    "check_unique": """
        select application_id, count(*) as n from stage_credits group by application_id having count(*) > 1
    """,
    "check_values": "select application_id, is_default from faulty where is_default not in (0, 1)",
    "check_range": """
        select application_id, 'employment_years' as column_name, cast(employment_years as double) as value
        from faulty where employment_years not between 0 and 100
        union all
        select application_id, 'income_total', income_total from faulty where income_total < 0
    """,
    "check_orphans": """
        select c.application_id, count(*) as n from stage_credits as c
        left join stage_applications as a on c.application_id = a.application_id and a.application_id % 7 <> 0
        where a.application_id is null
        group by c.application_id
    """,
    "check_contract": CONTRACT,
    "check_catalogue": _catalogue(),
    "score_auc": AUC,
    "score_ks": KS,
    "brier": BRIER,
    "reliability": RELIABILITY,
    "slice_metrics": SLICES,
    "metric_log": METRIC_LOG,
    "hash_split": HASH_SPLIT,
    "isotonic_scores": f"""
        select * replace ({rounded("predicted_pd")} as predicted_pd, {rounded("calibrated_pd", 9)} as calibrated_pd)
        from ({ISOTONIC})
    """,
    "calibration_verdict": VERDICT,
    "draft_sql_audit": AUDIT,
    "answer_scores": ANSWERS,
    "answer_accuracy": f"""
        select
            count(*) as questions, count(*) filter (where hit) as hits,
            round(avg(cast(hit as integer)), 4) as accuracy
        from ({ANSWERS})
    """,
}


def oracle_sql() -> dict[str, str]:
    """Each query with the steps it builds on as common table expressions."""
    steps = ",\n".join(f"{name} as ({sql})" for name, sql in STEPS.items())
    return {name: f"with {steps}\nselect * from ({sql}) as answer" for name, sql in FINAL.items()}
