"""DuckDB definitions of the domain views, mirroring adlake.sources.tables.

Used only by the SQL oracle: each oracle statement is prefixed with the
CTEs it needs (``with_views``)."""

from __future__ import annotations

from adlake import config

AS_OF = config.FIXTURE_AS_OF.isoformat()

VIEWS: dict[str, tuple[list[str], str]] = {
    "campaigns": (
        [],
        f"""
        SELECT p_partkey AS campaign_id, p_brand AS advertiser_name, p_type AS category,
          CASE WHEN p_partkey % 2 = 0 THEN 'auction' ELSE 'guaranteed' END AS demand_type,
          CASE WHEN p_partkey % 2 = 0
               THEN CAST((CAST(round(p_retailprice * 100) AS BIGINT) + 500) // 1000 AS DOUBLE) / CAST(100 AS DOUBLE)
          END AS bid,
          CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size AS DOUBLE) * 10 END AS budget,
          CASE WHEN p_partkey % 2 = 1 THEN CAST(p_size * 2 AS BIGINT) END AS impression_goal,
          CAST(DATE '2024-01-01' + CAST(p_partkey % 25 - 5 AS INTEGER) AS DATE) AS flight_start,
          CAST(DATE '2024-01-01' + CAST(p_partkey % 25 - 5 AS INTEGER) + CAST(10 + p_partkey % 30 AS INTEGER) AS DATE) AS flight_end,
          CASE WHEN DATE '2024-01-01' + CAST(p_partkey % 25 - 5 AS INTEGER) + CAST(10 + p_partkey % 30 AS INTEGER) < DATE '{AS_OF}' THEN 'ended'
               WHEN p_partkey % 8 = 0 THEN 'paused' ELSE 'active' END AS status,
          CASE WHEN p_partkey = 21 THEN ['frequent_airport_travelers']
               WHEN p_partkey = 22 THEN ['weekday_commuters']
               ELSE CAST([] AS VARCHAR[]) END AS targeted_audiences
        FROM part""",
    ),
    "users": (
        [],
        """
        SELECT c.c_custkey AS user_id, c.c_mktsegment AS segment, n.n_name AS home_metro, fo.created_at
        FROM customer c
        LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
        LEFT JOIN (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS created_at FROM orders GROUP BY o_custkey) fo
          ON c.c_custkey = fo.o_custkey""",
    ),
    "user_segments": ([], "SELECT c_custkey AS user_id, c_mktsegment AS segment FROM customer"),
    "ad_events": (
        ["campaigns"],
        """
        SELECT e.event_id,
          CASE WHEN e.event_type = 'view' THEN 'impression' ELSE 'click' END AS event_type,
          e.user_id, CAST(json_extract_string(e.props, '$.k') AS BIGINT) AS campaign_id,
          e.ts, CAST(e.ts AS DATE) AS event_date, CAST(hour(e.ts) AS BIGINT) AS hour_of_day,
          c.category
        FROM events e
        LEFT JOIN campaigns c ON CAST(json_extract_string(e.props, '$.k') AS BIGINT) = c.campaign_id
        WHERE e.event_type IN ('view', 'click')""",
    ),
    "rides": (
        [],
        """
        SELECT event_id AS ride_id, user_id, ts, CAST(ts AS DATE) AS ride_date,
          (['standard', 'shared', 'premium'])[CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) % 3 + 1 AS INTEGER)] AS ride_type
        FROM events WHERE event_type = 'purchase'""",
    ),
    "session_events": (
        ["campaigns"],
        """
        SELECT e.event_id,
          CASE e.event_type WHEN 'signup' THEN 'session_start' WHEN 'click' THEN 'destination_entered'
            WHEN 'purchase' THEN 'ride_type_selected' WHEN 'view' THEN 'app_screen_view' ELSE e.event_type END AS event_type,
          e.user_id,
          CAST(e.user_id AS VARCHAR) || '-' || strftime(e.ts, '%Y%m%d') AS session_id,
          e.ts,
          CASE WHEN e.event_type = 'click' THEN c.category END AS category,
          CASE WHEN e.event_type = 'purchase'
               THEN (['standard', 'shared', 'premium'])[CAST(CAST(json_extract_string(e.props, '$.k') AS BIGINT) % 3 + 1 AS INTEGER)]
          END AS ride_type
        FROM events e
        LEFT JOIN campaigns c ON CAST(json_extract_string(e.props, '$.k') AS BIGINT) = c.campaign_id""",
    ),
    "requests": (
        [],
        """
        SELECT event_id AS request_id, user_id, ts, CAST(ts AS DATE) AS request_date,
          CAST(hour(ts) AS BIGINT) AS hour_of_day
        FROM events WHERE event_type = 'view'""",
    ),
    "external_bids": (
        [],
        """
        SELECT event_id AS request_id, CASE WHEN event_id % 3 = 0 THEN value / 100.0 END AS bid
        FROM events WHERE event_type = 'view'""",
    ),
    "registry": ([], config.registry_sql()),
    "lift_rules": ([], config.lift_rules_sql()),
}


def _order(names: list[str]) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        if n in out:
            return
        for d in VIEWS[n][0]:
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def with_views(body: str, *names: str, extra: list[tuple[str, str]] | None = None) -> str:
    """Prefix ``body`` with the CTEs of ``names`` (dependencies included)
    followed by ``extra`` (name, sql) CTEs in order."""
    ctes = [f"{n} AS ({VIEWS[n][1]})" for n in _order(list(names))]
    ctes += [f"{n} AS ({sql})" for n, sql in (extra or [])]
    if not ctes:
        return body
    return "WITH " + ",\n".join(ctes) + "\n" + body
