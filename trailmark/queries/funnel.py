"""Funnel queries over all events; ``*_one_day`` show the date range."""

from __future__ import annotations

from trailmark.operators import funnel as fn
from trailmark.queries.base import Registry, pct, rnd

registry = Registry()
STEPS = [("Viewed", "view"), ("Clicked", "click"), ("Purchased", "purchase")]
DAY = ("2024-01-02", "2024-01-02 23:59:59.999999")
IN_DAY = "timestamp BETWEEN TIMESTAMP '2024-01-02 00:00:00' AND TIMESTAMP '2024-01-02 23:59:59.999999'"



def kinds_sql(events: str = "events_e", where: str = "true") -> str:
    """CTE ``who``: each user with the list of kinds of their events."""
    return f"""who AS (SELECT user_id, list(DISTINCT event_type) AS kinds FROM {events} WHERE user_id IS NOT NULL AND {where} GROUP BY user_id)"""


def funnel_sql(segment: str | None = None, steps=STEPS, where: str = "true", events: str = "events_e", users: str = "users_e") -> str:
    """CTE ``f``: per segment, users whose list holds the first step, and of these those that hold each other one."""
    first = f"list_contains(kinds, '{steps[0][1]}')"
    held = ", ".join(f"count(*) FILTER (list_contains(kinds, '{event}')) AS step_{i}_users" for i, (_, event) in enumerate(steps))
    side = f"LEFT JOIN (SELECT DISTINCT user_id, {segment} FROM {users}) USING (user_id)" if segment else ""
    by = (f"{segment}, ", f"GROUP BY {segment}") if segment else ("", "")
    return f"WITH {kinds_sql(events, where)}, f AS (SELECT {by[0]}{held} FROM who {side} WHERE {first} {by[1]})"


RATES = f"""step_0_users, step_1_users, step_2_users,
    {pct('step_1_users', 'step_0_users')} AS step_0_to_1_rate, {pct('step_1_users', 'step_0_users')} AS step_0_to_1_incremental,
    {pct('step_2_users', 'step_0_users')} AS step_0_to_2_rate, {pct('step_2_users', 'step_1_users')} AS step_1_to_2_incremental"""
OVERALL = funnel_sql()


def funnel(v, segment=None, days=None):
    return fn.calculate_funnel(v.events_e, STEPS, v.users_e if segment else None, segment, days)[0]


@registry.add("funnel_overall", f"{OVERALL} SELECT {RATES} FROM f")
def _(v):
    return funnel(v)


@registry.add("funnel_by_segment", f"{funnel_sql('acquisition_channel')} SELECT acquisition_channel, {RATES} FROM f")
def _(v):
    return funnel(v, "acquisition_channel")


@registry.add("funnel_one_day", f"{funnel_sql(where=IN_DAY)} SELECT {RATES} FROM f")
def _(v):
    return funnel(v, None, DAY)


@registry.add(
    "funnel_by_segment_one_day",
    f"{funnel_sql('acquisition_channel', where=IN_DAY)} SELECT acquisition_channel, {RATES} FROM f",
)
def _(v):
    return funnel(v, "acquisition_channel", DAY)


@registry.add(
    "funnel_by_segment_all_days",
    f"{funnel_sql('country')} SELECT country, {RATES} FROM f",
)
def _(v):
    return fn.calculate_funnel(v.events_e, STEPS, v.users_e, "country")[0]


@registry.add(
    "funnel_top_segments",
    f"""{funnel_sql('country')} SELECT country, step_0_users, {pct('step_1_users', 'step_0_users')} AS step_0_to_1_rate,
        {pct('step_2_users', 'step_0_users')} AS step_0_to_2_rate FROM f ORDER BY step_0_users DESC, country LIMIT 6""",
)
def _(v):
    return fn.top_segments(funnel(v, "country"), "country", 6)


@registry.add(
    "funnel_long",
    f"""{OVERALL} SELECT 0 AS step, 'Viewed' AS label, step_0_users AS users, {pct('step_0_users', 'step_0_users')} AS pct_of_first,
        step_0_users - step_1_users AS drop_off, {pct('step_0_users - step_1_users', 'step_0_users')} AS drop_off_pct FROM f
    UNION ALL SELECT 1, 'Clicked', step_1_users, {pct('step_1_users', 'step_0_users')}, step_1_users - step_2_users,
        {pct('step_1_users - step_2_users', 'step_1_users')} FROM f
    UNION ALL SELECT 2, 'Purchased', step_2_users, {pct('step_2_users', 'step_0_users')}, NULL, NULL FROM f""",
)
def _(v):
    return fn.funnel_long(funnel(v), STEPS)


@registry.add(
    "funnel_validity",
    f"""{funnel_sql('acquisition_channel')}
    SELECT acquisition_channel, 'step_0_to_1' AS stage, step_1_users <= step_0_users AS not_rising,
        coalesce({pct('step_1_users', 'step_0_users')} <= 100, true) AS incremental_ok, {pct('step_1_users', 'step_0_users')} AS value FROM f
    UNION ALL SELECT acquisition_channel, 'step_1_to_2', step_2_users <= step_1_users,
        coalesce({pct('step_2_users', 'step_1_users')} <= 100, true), {pct('step_2_users', 'step_1_users')} FROM f""",
)
def _(v):
    return fn.funnel_validity(funnel(v, "acquisition_channel"), STEPS, ["acquisition_channel"])


ORDERED = """WITH t0 AS (SELECT user_id, session_id, min(timestamp) AS t FROM events_e WHERE event_type = 'view' GROUP BY ALL),
    t1 AS (SELECT e.user_id, e.session_id, min(e.timestamp) AS t FROM events_e e JOIN t0 USING (user_id, session_id)
           WHERE e.event_type = 'click' AND e.timestamp > t0.t GROUP BY ALL),
    t2 AS (SELECT e.user_id, e.session_id, min(e.timestamp) AS t FROM events_e e JOIN t1 USING (user_id, session_id)
           WHERE e.event_type = 'purchase' AND e.timestamp > t1.t GROUP BY ALL),
    f AS (SELECT u.acquisition_channel, count(DISTINCT t0.user_id) AS step_0_users, count(DISTINCT t1.user_id) AS step_1_users,
             count(DISTINCT t2.user_id) AS step_2_users
          FROM t0 LEFT JOIN t1 USING (user_id, session_id) LEFT JOIN t2 USING (user_id, session_id)
          LEFT JOIN users_e u ON t0.user_id = u.user_id GROUP BY u.acquisition_channel)"""


@registry.add("funnel_ordered", f"{ORDERED} SELECT acquisition_channel, {RATES} FROM f")
def _(v):
    return fn.calculate_funnel(
        v.events_e, STEPS, v.users_e, "acquisition_channel", mode="ordered", within="session_id"
    )[0]


# Of each user's opening events of the two kinds, the one that follows the other.
DIFFS = """opening AS (SELECT user_id, event_type, timestamp FROM events_e WHERE event_type IN ('view', 'purchase')
        QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY timestamp) = 1),
    follow AS (SELECT *, lead(timestamp) OVER (PARTITION BY user_id ORDER BY timestamp) AS later FROM opening),
    d AS (SELECT acquisition_channel, epoch_us(later - timestamp) / 86400e6 AS days
        FROM follow LEFT JOIN (SELECT DISTINCT user_id, acquisition_channel FROM users_e) USING (user_id)
        WHERE event_type = 'view' AND later > timestamp)"""
SPREAD = f"""count(*) AS converted_users, {rnd('quantile_cont(days, 0.5)', 2)} AS median_days,
    {rnd('quantile_cont(days, 0.25)', 2)} AS p25_days, {rnd('quantile_cont(days, 0.75)', 2)} AS p75_days,
    {rnd('quantile_cont(days, 0.9)', 2)} AS p90_days"""


@registry.add("time_to_convert", f"WITH {DIFFS} SELECT {SPREAD} FROM d")
def _(v):
    return fn.calculate_time_to_convert(v.events_e, "view", "purchase")


@registry.add(
    "time_to_convert_by_segment", f"WITH {DIFFS} SELECT acquisition_channel, {SPREAD} FROM d GROUP BY acquisition_channel"
)
def _(v):
    return fn.calculate_time_to_convert(v.events_e, "view", "purchase", v.users_e, "acquisition_channel")


def drop_off_sql(steps=STEPS, where: str = "true", events: str = "events_e", users: str = "users_e") -> str:
    """Users whose list holds a step, by whether it holds the next one; ranked within the step."""
    pairs = ", ".join(f"({i}, '{a}', '{b}', '{c}')" for i, ((a, b), (_, c)) in enumerate(zip(steps, steps[1:])))
    return f"""WITH {kinds_sql(events, where)}, stages(stage_no, dropped_at_stage, own, next) AS (VALUES {pairs}),
    at_stage AS (SELECT stage_no, dropped_at_stage, country, acquisition_channel, NOT list_contains(kinds, next) AS dropped
        FROM who JOIN stages ON list_contains(kinds, own) LEFT JOIN {users} USING (user_id)),
    told AS (SELECT dropped_at_stage, sum(dropped::INT)::BIGINT AS dropped_users, country, acquisition_channel, count(*) AS users_in_segment
        FROM at_stage GROUP BY stage_no, dropped_at_stage, country, acquisition_channel HAVING bool_or(dropped)
        QUALIFY row_number() OVER (PARTITION BY stage_no ORDER BY dropped_users DESC, country NULLS FIRST, acquisition_channel NULLS FIRST) <= 10)
    SELECT *, {pct('dropped_users', 'users_in_segment')} AS drop_off_rate FROM told"""


@registry.add("drop_off_reasons", drop_off_sql())
def _(v):
    return fn.calculate_drop_off_reasons(v.events_e, v.users_e, STEPS)


@registry.add("drop_off_reasons_one_day", drop_off_sql(where=IN_DAY))
def _(v):
    return fn.calculate_drop_off_reasons(v.events_e, v.users_e, STEPS, date_range=DAY)


# The same over orders, where a user's steps differ.
ORDER_STEPS = [("Open", "O"), ("Pending", "P"), ("Filled", "F")]


@registry.add(
    "funnel_orders",
    f"{funnel_sql('acquisition_channel', ORDER_STEPS, events='events_o', users='users_o')} SELECT acquisition_channel, {RATES} FROM f",
)
def _(v):
    return fn.calculate_funnel(v.events_o, ORDER_STEPS, v.users_o, "acquisition_channel")[0]


# Each order's place among its user's, and the place of the next order of the kind that must follow.
ORDERS_IN_TURN = """o AS (SELECT user_id, event_type, timestamp AS t FROM events_o WHERE user_id IS NOT NULL),
    a AS (SELECT user_id, min(t) AS t0 FROM o WHERE event_type = 'O' GROUP BY user_id),
    n AS (SELECT user_id, t0, list_sort(list(t) FILTER (event_type = 'P')) AS ps, list_sort(list(t) FILTER (event_type = 'F')) AS fs
          FROM a JOIN o USING (user_id) GROUP BY user_id, t0),
    p AS (SELECT user_id, list_filter(coalesce(ps, []), lambda x: x > t0)[1] AS t1, fs FROM n),
    q AS (SELECT user_id, t1, list_filter(coalesce(fs, []), lambda x: x > t1)[1] AS t2 FROM p),
    f AS (SELECT count(*) AS step_0_users, count(t1) AS step_1_users, count(t2) AS step_2_users FROM q)"""


@registry.add("funnel_orders_in_turn", f"WITH {ORDERS_IN_TURN} SELECT {RATES} FROM f")
def _(v):
    return fn.calculate_funnel(v.events_o, ORDER_STEPS, mode="ordered")[0]


@registry.add("drop_off_orders", drop_off_sql(ORDER_STEPS, events="events_o", users="users_o"))
def _(v):
    return fn.calculate_drop_off_reasons(v.events_o, v.users_o, ORDER_STEPS)


STAGES = [("views", "view"), ("clicks", "click"), ("purchases", "purchase"), ("errors", "error")]
EXPERIMENT = f"""x AS (SELECT user_id, variant FROM assignments WHERE experiment_id = 'exp_001'),
    f AS (SELECT variant, {', '.join(f"count(DISTINCT CASE WHEN event_type = '{e}' THEN user_id END) AS {n}" for n, e in STAGES)}
          FROM (SELECT e.user_id, x.variant, e.event_type FROM events_e e JOIN x ON e.user_id = x.user_id)
          GROUP BY variant)"""


def experiment(v):
    return fn.experiment_funnel(v.events_e, v.assignments, "exp_001", STAGES)


@registry.add(
    "experiment_funnel",
    f"WITH {EXPERIMENT} SELECT variant, views, clicks, purchases, errors, "
    + ", ".join(f"{pct(n, 'views')} AS {n}_rate" for n, _ in STAGES[1:])
    + " FROM f",
)
def _(v):
    return experiment(v)


@registry.add(
    "experiment_funnel_lift",
    f"WITH {EXPERIMENT}, "
    + "r AS ("
    + " UNION ALL ".join(f"SELECT variant, '{n}' AS stage, {pct(n, 'views')} AS rate FROM f" for n, _ in STAGES[1:])
    + f""")
    SELECT c.stage, c.rate AS control_rate, t.rate AS treatment_rate,
        CASE WHEN c.rate > 0 THEN {rnd('(t.rate - c.rate) / c.rate * 100', 1)} WHEN c.rate = 0 THEN 0.0 END AS lift_pct
    FROM r c JOIN r t ON c.stage = t.stage WHERE c.variant = 'control' AND t.variant = 'treatment'""",
)
def _(v):
    return fn.experiment_funnel_lift(experiment(v), STAGES)
