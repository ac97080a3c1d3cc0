"""DuckDB SQL for the queries, written from the semantics and not from the DataFrame code."""

from __future__ import annotations

PLATFORMS = "['PS','PS2','PS3','PS4','PS5','PSP','PSV','XB','X360','XOne','XS','XBL']"
CHANNELS = (
    "['physical_retail','physical_online','digital_store','membership_included','membership_fee','console_hardware']"
)
AS_OF = "DATE '2001-12-31'"
AS_OF_TS = "TIMESTAMP '2001-12-31 00:00:00'"

ERA = """CASE WHEN {y} < 2000 THEN '90s' WHEN {y} < 2010 THEN '00s' WHEN {y} < 2020 THEN '10s' ELSE '20s' END"""

# Each common table expression with the ones it needs.
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "consoles": (
        (),
        """SELECT platform_code, console_family, generation::SMALLINT AS generation, launch_year::SMALLINT AS launch_year,
             CASE WHEN launch_year > 1989 AND launch_year <= 1999 THEN '90s'
                  WHEN launch_year > 1999 AND launch_year <= 2009 THEN '00s'
                  WHEN launch_year > 2009 AND launch_year <= 2019 THEN '10s'
                  WHEN launch_year > 2019 AND launch_year <= 2029 THEN '20s' END AS era
           FROM (VALUES ('PS','PlayStation',5,1994), ('PS2','PlayStation',6,2000), ('PS3','PlayStation',7,2006),
             ('PS4','PlayStation',8,2013), ('PS5','PlayStation',9,2020), ('PSP','PlayStation',NULL,2004),
             ('PSV','PlayStation',NULL,2011), ('XB','Xbox',6,2001), ('X360','Xbox',7,2005), ('XOne','Xbox',8,2013),
             ('XS','Xbox',9,2020), ('XBL','Xbox',NULL,NULL)) t(platform_code, console_family, generation, launch_year)""",
    ),
    "channels": (
        (),
        """SELECT * FROM (VALUES
             ('physical_retail','PHYSICAL','Boxed disc/cartridge bought in store',true),
             ('physical_online','PHYSICAL','Boxed copy shipped from an online retailer',true),
             ('digital_store','DIGITAL','PS Store / Microsoft Store download',false),
             ('membership_included','MEMBERSHIP','Title claimed via PS Plus / Game Pass',false),
             ('membership_fee','MEMBERSHIP','Recurring subscription charge',false),
             ('console_hardware','HARDWARE','Console purchase (PS/Xbox SKU)',true))
             t(channel_code, channel_type, description, is_shippable)""",
    ),
    "ev": (
        (),
        f"""SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y%m%d')) AS event_id,
             l_orderkey, l_partkey, l_shipdate AS occurred_at, o_custkey::VARCHAR AS player_id,
             ({PLATFORMS})[p_size % 12 + 1] AS platform, ({CHANNELS})[l_linenumber % 6 + 1] AS channel_code,
             l_partkey::VARCHAR AS product_id,
             CASE WHEN l_linenumber % 6 = 5 THEN 'CONSOLE' ELSE 'GAME' END AS product_type,
             p_name AS title, p_type AS genre, p_brand AS publisher, r_name AS region,
             l_quantity::INTEGER AS quantity, p_retailprice AS unit_price,
             CASE WHEN l_discount = 0 THEN NULL ELSE l_discount END AS discount_pct,
             l_returnflag = 'R' AS is_preowned,
             CASE WHEN l_linenumber % 6 IN (3, 4) AND o_orderpriority <> '5-LOW' THEN o_orderpriority END AS membership_tier
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
             JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
             JOIN region ON n_regionkey = r_regionkey""",
    ),
    "cev": (
        ("ev", "consoles", "channels"),
        """SELECT ev.*, upper(platform) AS platform_code, channel_type, is_shippable, console_family, era,
             round(unit_price * quantity * (1 - coalesce(discount_pct, 0)), 4) AS net_revenue,
             channel_type = 'MEMBERSHIP' AS is_membership, channel_type = 'PHYSICAL' AS is_physical
           FROM ev LEFT JOIN channels USING (channel_code)
             LEFT JOIN consoles ON upper(consoles.platform_code) = upper(ev.platform)""",
    ),
    "dirty": (
        ("cev",),
        f"""SELECT * EXCLUDE (price_ok, discount_ok, tier_ok),
             price_ok IS NOT FALSE AS price_ok, discount_ok IS NOT FALSE AS discount_ok, tier_ok IS NOT FALSE AS tier_ok
           FROM (SELECT *, price > 0 OR channel_code = 'membership_included' AS price_ok,
               disc IS NULL OR (disc >= 0 AND disc <= 1) AS discount_ok,
               channel_code NOT LIKE 'membership%' OR membership_tier IS NOT NULL AS tier_ok
             FROM (SELECT event_id, occurred_at, channel_code, membership_tier, quantity,
               CASE WHEN l_orderkey % 103 = 0 THEN NULL WHEN l_partkey % 97 = 0 THEN 0.0 ELSE unit_price END AS price,
               CASE WHEN l_orderkey % 101 = 0 THEN 1.5 ELSE discount_pct END AS disc FROM cev))""",
    ),
    "sev": (
        ("cev",),
        f"""SELECT * FROM cev
           WHERE (unit_price > 0 OR channel_code = 'membership_included') IS NOT FALSE
             AND (discount_pct IS NULL OR discount_pct BETWEEN 0 AND 1) IS NOT FALSE
             AND (channel_code NOT LIKE 'membership%' OR membership_tier IS NOT NULL)
             AND (occurred_at <= {AS_OF_TS} + INTERVAL 5 MINUTE) IS NOT FALSE""",
    ),
    "listing": (
        ("ev",),
        """SELECT title, platform, genre, publisher,
             CASE WHEN length(title || genre || publisher) % 13 = 0 THEN NULL ELSE year(occurred_at) END::INTEGER AS release_year,
             sum(CASE WHEN region = 'AMERICA' THEN quantity ELSE 0 END)::DOUBLE AS na_sales,
             sum(CASE WHEN region = 'EUROPE' THEN quantity ELSE 0 END)::DOUBLE AS eu_sales,
             sum(CASE WHEN region = 'ASIA' THEN quantity ELSE 0 END)::DOUBLE AS jp_sales,
             sum(CASE WHEN region IN ('AFRICA', 'MIDDLE EAST') THEN quantity ELSE 0 END)::DOUBLE AS other_sales,
             (sum(quantity) + CASE WHEN length(title) % 7 = 0 THEN 1 ELSE 0 END)::DOUBLE AS global_sales_musd
           FROM ev GROUP BY title, platform, genre, publisher, year(occurred_at)""",
    ),
    "scores": (
        (),
        f"""SELECT p_name AS title, upper(({PLATFORMS})[p_size % 12 + 1]) AS platform_code,
             p_size * 2.0::DOUBLE AS critic_score, CASE WHEN p_type <> 'ECONOMY' THEN p_size / 5.0::DOUBLE END AS user_score,
             p_type AS esrb_rating
           FROM part
           QUALIFY row_number() OVER (PARTITION BY p_name, upper(({PLATFORMS})[p_size % 12 + 1])
             ORDER BY p_size DESC, p_size / 5.0 * (CASE WHEN p_type <> 'ECONOMY' THEN 1 END) DESC NULLS LAST, p_type DESC) = 1""",
    ),
    "csales": (
        ("listing", "scores", "consoles"),
        f"""SELECT b.title, b.platform_code, b.release_year, genre, publisher, na_sales, eu_sales, jp_sales, other_sales,
             global_sales_musd, console_family, generation, launch_year,
             coalesce(era, {ERA.format(y="b.release_year")}) AS era, critic_score, user_score, esrb_rating
           FROM (SELECT *, upper(platform) AS platform_code FROM listing WHERE release_year >= 1990
             QUALIFY row_number() OVER (PARTITION BY title, upper(platform), release_year
               ORDER BY global_sales_musd DESC, na_sales DESC, eu_sales DESC, jp_sales DESC, other_sales DESC,
                 publisher DESC, genre DESC) = 1) b
           JOIN consoles ON upper(consoles.platform_code) = b.platform_code
           LEFT JOIN scores ON scores.title = b.title AND scores.platform_code = b.platform_code""",
    ),
    "ssales": (
        ("csales",),
        """SELECT * FROM csales WHERE length(trim(title)) > 0 AND release_year BETWEEN 1990 AND 2002
             AND global_sales_musd >= 0
             AND abs(na_sales + eu_sales + jp_sales + other_sales - global_sales_musd) < 0.05""",
    ),
    "cdc": (
        (),
        """SELECT 'S' || o_custkey AS _pk,
             CASE WHEN o_orderkey % 17 = 0 THEN 'd' WHEN o_orderstatus = 'O' THEN 'c' ELSE 'u' END AS _op,
             date_diff('day', DATE '1970-01-01', o_orderdate::DATE)::BIGINT * 10000000000000 + o_orderkey AS _lsn,
             o_orderdate AS _committed_at, 'S' || o_custkey AS subscription_id, o_custkey::VARCHAR AS player_id,
             o_orderpriority AS membership_tier,
             CASE o_orderstatus WHEN 'O' THEN 'ACTIVE' WHEN 'F' THEN 'CANCELLED' ELSE 'LAPSED' END AS status,
             strftime(o_orderdate, '%Y-%m-%d') AS started_at, NULL::VARCHAR AS renews_at,
             o_totalprice::DECIMAL(18,2)::VARCHAR AS mrr, o_orderkey % 4 AS batch
           FROM orders""",
    ),
    "hist": (
        ("cdc",),
        """SELECT * EXCLUDE (batch), _op = 'd' AS is_deleted, _committed_at AS valid_from,
             lead(_committed_at) OVER w AS valid_to, lead(_lsn) OVER w IS NULL AS is_current
           FROM cdc WINDOW w AS (PARTITION BY _pk ORDER BY _lsn)""",
    ),
    "p360": (
        ("sev", "hist"),
        f"""SELECT player_id, max(occurred_at) AS last_purchase_at, min(occurred_at) AS first_purchase_at,
             count(*) AS purchase_count, sum(net_revenue::DECIMAL(18,4))::DOUBLE AS lifetime_value,
             sum(net_revenue::DECIMAL(18,4))::DOUBLE / count(net_revenue) AS avg_order_value,
             coalesce(sum(net_revenue::DECIMAL(18,4)) FILTER (is_physical), 0)::DOUBLE AS physical_spend,
             coalesce(sum(net_revenue::DECIMAL(18,4)) FILTER (channel_type = 'DIGITAL'), 0)::DOUBLE AS digital_spend,
             coalesce(sum(net_revenue::DECIMAL(18,4)) FILTER (is_membership), 0)::DOUBLE AS membership_spend,
             count(DISTINCT platform_code) AS platforms_used,
             array_to_string(list_sort(list(DISTINCT console_family) FILTER (console_family IS NOT NULL)), ',') AS console_families,
             date_diff('day', max(occurred_at)::DATE, {AS_OF})::INTEGER AS recency_days,
             date_diff('day', min(occurred_at)::DATE, {AS_OF})::INTEGER AS tenure_days,
             coalesce(sum(net_revenue::DECIMAL(18,4)) FILTER (channel_type = 'DIGITAL'), 0)::DOUBLE
               / nullif(sum(net_revenue::DECIMAL(18,4))::DOUBLE, 0) AS digital_share,
             (date_diff('day', max(occurred_at)::DATE, {AS_OF}) > 90)::INTEGER AS is_churned,
             any_value(s.membership_tier) AS membership_tier, any_value(s.status) AS membership_status,
             any_value(s.mrr::DOUBLE) AS mrr
           FROM sev LEFT JOIN (SELECT player_id, membership_tier, status, mrr FROM hist WHERE is_current AND NOT is_deleted) s
             USING (player_id) GROUP BY player_id""",
    ),
    "fplayer": (
        ("p360",),
        """SELECT player_id, recency_days, tenure_days, purchase_count, lifetime_value, avg_order_value,
             coalesce(digital_share, 0) AS digital_share, platforms_used, coalesce(membership_tier, 'NONE') AS membership_tier,
             coalesce(membership_status, 'NONE') AS membership_status, coalesce(mrr, 0) AS mrr, is_churned,
             round(ln(1 + lifetime_value), 6) AS log_ltv, round(ln(1 + purchase_count), 6) AS log_purchases
           FROM p360""",
    ),
    "mart": (
        ("ssales", "sev"),
        """SELECT * FROM (SELECT era, console_family, platform_code, 'PHYSICAL' AS channel_type, genre,
               sum(global_sales_musd) AS physical_units_m, count(DISTINCT title) AS titles_released,
               sum(critic_score) / count(critic_score) AS avg_critic_score
             FROM ssales GROUP BY era, console_family, platform_code, genre)
           FULL JOIN (SELECT era, console_family, platform_code, channel_type,
               sum(net_revenue::DECIMAL(18,4))::DOUBLE AS net_revenue, count(DISTINCT player_id) AS buyers,
               count(*) AS transactions FROM sev GROUP BY ALL)
           USING (era, console_family, platform_code, channel_type)""",
    ),
    "life": (
        ("ssales",),
        """SELECT *, (release_year - launch_year)::INTEGER AS years_since_launch,
             sum(software_units_m) OVER (PARTITION BY platform_code ORDER BY release_year) AS cumulative_units_m,
             software_units_m / titles AS attach_rate_proxy
           FROM (SELECT console_family, platform_code, generation, launch_year, release_year,
             sum(global_sales_musd) AS software_units_m, count(DISTINCT title) AS titles FROM ssales GROUP BY ALL)""",
    ),
    "inter": (
        ("sev",),
        """SELECT *, round(ln(1 + purchases) + ln(1 + spend / 10), 6) AS confidence,
             row_number() OVER (PARTITION BY player_id ORDER BY last_seen DESC, product_id)::INTEGER AS _rank_desc
           FROM (SELECT player_id, product_id, title, platform_code, console_family, count(*) AS purchases,
             sum(net_revenue::DECIMAL(18,4))::DOUBLE AS spend, max(occurred_at) AS last_seen
             FROM sev WHERE product_type = 'GAME' GROUP BY ALL)""",
    ),
    "ts": (
        ("sev",),
        """SELECT * EXCLUDE (rev) FROM (
             SELECT ds, platform_code, channel_type, rev, rev::DOUBLE AS revenue, transactions,
               lag(rev, 1) OVER w::DOUBLE AS revenue_lag_1, lag(rev, 7) OVER w::DOUBLE AS revenue_lag_7,
               lag(rev, 28) OVER w::DOUBLE AS revenue_lag_28,
               sum(rev) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)::DOUBLE
                 / count(*) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS revenue_roll_7,
               sum(rev) OVER (w ROWS BETWEEN 27 PRECEDING AND CURRENT ROW)::DOUBLE
                 / count(*) OVER (w ROWS BETWEEN 27 PRECEDING AND CURRENT ROW) AS revenue_roll_28,
               (dayofweek(ds) + 1)::INTEGER AS dow, month(ds)::INTEGER AS month,
               (month(ds) IN (11, 12))::INTEGER AS is_holiday_season
             FROM (SELECT date_trunc('day', occurred_at)::TIMESTAMP AS ds, platform_code, channel_type,
               sum(net_revenue::DECIMAL(18,4)) AS rev, count(*) AS transactions FROM sev GROUP BY ALL)
             WINDOW w AS (PARTITION BY platform_code, channel_type ORDER BY ds))
           WHERE revenue_lag_28 IS NOT NULL""",
    ),
    "split": (
        ("ts",),
        """SELECT *, CASE WHEN row_number() OVER (PARTITION BY platform_code, channel_type ORDER BY ds)
               <= floor(count(*) OVER (PARTITION BY platform_code, channel_type) * 0.85) THEN 'train' ELSE 'validation' END AS split
           FROM ts""",
    ),
    "msg": (
        (),
        f"""SELECT event_id AS src_id, 'E' || event_id AS event_id, user_id::VARCHAR AS player_id,
             ({PLATFORMS})[user_id % 12 + 1] AS platform,
             CASE event_type WHEN 'click' THEN 'digital_store' WHEN 'error' THEN 'physical_retail'
               WHEN 'purchase' THEN 'physical_online' WHEN 'signup' THEN 'membership_fee' ELSE 'membership_included' END AS channel_code,
             ts AS occurred_at, (1 + event_id % 3)::INTEGER AS quantity, value AS unit_price,
             CASE WHEN (props->>'$.k')::INTEGER % 4 <> 0 THEN ((props->>'$.k')::INTEGER % 4) * 0.25::DOUBLE END AS discount_pct,
             CASE event_id % 50 WHEN 0 THEN 'unparseable' WHEN 1 THEN 'missing mandatory keys'
               WHEN 2 THEN 'missing unit_price' WHEN 3 THEN 'missing mandatory keys' END AS error
           FROM events""",
    ),
    "good": (
        ("msg",),
        """SELECT *, round(unit_price * quantity * (1 - coalesce(discount_pct, 0)), 4) AS net_revenue
           FROM msg WHERE error IS NULL""",
    ),
    "slid": (
        ("good",),
        """SELECT window_start, window_start + INTERVAL 60 SECOND AS window_end, platform, channel_code,
             sum(net_revenue::DECIMAL(18,4))::DOUBLE AS net_revenue
           FROM (SELECT *, time_bucket(INTERVAL 15 SECOND, occurred_at) - to_seconds(15 * i) AS window_start
             FROM good CROSS JOIN range(4) t(i)) GROUP BY ALL""",
    ),
    "todo": (
        ("ssales",),
        """SELECT title, platform_code, era, genre, publisher, global_sales_musd FROM ssales s
           WHERE NOT EXISTS (SELECT 1 FROM ssales d WHERE d.generation <= 7 AND d.title = s.title AND d.platform_code = s.platform_code)
           ORDER BY global_sales_musd DESC, title, platform_code, era, genre, publisher""",
    ),
    "docs": (
        (),
        f"""SELECT p_partkey, p_name AS title, ({PLATFORMS})[p_size % 12 + 1] AS platform_code,
             p_name || ' — ' || ({PLATFORMS})[p_size % 12 + 1] || ' — ' || p_type || ' — '
               || (CASE WHEN p_size > 10 THEN p_brand ELSE '' END) AS document FROM part""",
    ),
    "top_seen": (
        ("inter",),
        """SELECT 'purchases' AS m, product_id FROM (SELECT product_id FROM inter WHERE _rank_desc > 1 GROUP BY product_id
             ORDER BY sum(purchases) DESC, product_id LIMIT 10)
           UNION ALL SELECT 'spend', product_id FROM (SELECT product_id FROM inter WHERE _rank_desc > 1 GROUP BY product_id
             ORDER BY sum(spend::DECIMAL(18,4)) DESC, product_id LIMIT 10)""",
    ),
    "recall": (
        ("inter", "top_seen"),
        """SELECT m, count(*) AS relevant, count(hit) AS hits, count(hit) / count(*) AS recall
           FROM (SELECT r.product_id, ms.m, t.product_id AS hit FROM inter r CROSS JOIN (VALUES ('purchases'), ('spend')) ms(m)
             LEFT JOIN top_seen t ON t.m = ms.m AND t.product_id = r.product_id WHERE r._rank_desc = 1) GROUP BY m""",
    ),
}

HIST_COLUMNS = """_pk, _op, _lsn, _committed_at, subscription_id, player_id, membership_tier, status, started_at, renews_at,
  mrr, is_deleted, valid_from, valid_to, is_current"""

SALES_COLUMNS = """title, platform_code, release_year, genre, publisher, na_sales, eu_sales, jp_sales, other_sales,
  global_sales_musd, console_family, generation, launch_year, era, critic_score, user_score, esrb_rating"""

VALID_AT = "valid_from <= {t} AND (valid_to IS NULL OR valid_to > {t}) AND NOT is_deleted"

REVENUE = "round(price * quantity * (1 - coalesce(disc, 0)), 4) AS net_revenue"

# Query key -> (common table expressions, final SELECT).
SELECTS: dict[str, tuple[tuple[str, ...], str]] = {
    "era_binning": (("ev",), f"SELECT event_id, {ERA.format(y='year(occurred_at)')} AS era FROM ev"),
    "net_revenue": (("cev",), "SELECT event_id, net_revenue FROM cev"),
    "dim_console": (
        ("consoles", "ev"),
        """SELECT c.*, coalesce(n, 0) AS purchases FROM consoles c
           LEFT JOIN (SELECT upper(platform) AS p, count(*) AS n FROM ev GROUP BY 1) ON p = upper(c.platform_code)""",
    ),
    "dim_channel": (
        ("channels", "ev"),
        """SELECT c.*, coalesce(n, 0) AS purchases FROM channels c
           LEFT JOIN (SELECT channel_code, count(*) AS n FROM ev GROUP BY 1) USING (channel_code)""",
    ),
    "dedup_natural_key": (
        (),
        """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate FROM lineitem
           QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
             ORDER BY l_extendedprice DESC, l_partkey DESC, l_suppkey DESC, l_shipdate DESC) = 1""",
    ),
    "silver_game_sales": (("ssales",), f"SELECT {SALES_COLUMNS} FROM ssales"),
    "silver_purchase_events": (
        ("sev",),
        """SELECT event_id, occurred_at, player_id, platform_code, channel_code, product_type, title, quantity, unit_price,
             discount_pct, is_preowned, membership_tier, channel_type, is_shippable, console_family, era, net_revenue,
             is_membership, is_physical FROM sev""",
    ),
    "dq_sales_rules": (
        ("csales",),
        """SELECT title, platform_code, release_year, 'regions_sum_matches' AS failed_rules FROM csales
           WHERE NOT abs(na_sales + eu_sales + jp_sales + other_sales - global_sales_musd) < 0.05""",
    ),
    "dq_event_rules": (
        ("dirty",),
        """SELECT event_id, price_ok AND discount_ok AND tier_ok AS is_valid,
             ((NOT price_ok)::INTEGER + (NOT discount_ok)::INTEGER + (NOT tier_ok)::INTEGER)::INTEGER AS failures FROM dirty""",
    ),
    "dq_quarantine": (
        ("dirty",),
        """SELECT event_id, concat_ws(',', CASE WHEN NOT price_ok THEN 'price_positive' END,
             CASE WHEN NOT discount_ok THEN 'discount_bounded' END,
             CASE WHEN NOT tier_ok THEN 'membership_tier_consistency' END) AS failed_rules
           FROM dirty WHERE NOT (price_ok AND discount_ok AND tier_ok)""",
    ),
    "dq_drop": (("dirty",), f"SELECT event_id, {REVENUE} FROM dirty WHERE price_ok AND discount_ok AND tier_ok"),
    "dq_drop_per_rule": (("dirty",), f"SELECT event_id, {REVENUE} FROM dirty WHERE price_ok AND discount_ok"),
    "dq_summary": (
        ("dirty",),
        """SELECT 'price_positive' AS rule, count(*) AS failures FROM dirty WHERE NOT price_ok
           UNION ALL SELECT 'discount_bounded', count(*) FROM dirty WHERE NOT discount_ok
           UNION ALL SELECT 'membership_tier_consistency', count(*) FROM dirty WHERE NOT tier_ok""",
    ),
    "freshness_gate": (
        (),
        """SELECT 'returned_orders' AS table_name
           WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderstatus = 'R')""",
    ),
    "quarantine_report": (
        ("dirty",),
        """SELECT rule, count(*) AS failures FROM (
             SELECT occurred_at, unnest(['price_positive', 'discount_bounded', 'membership_tier_consistency']) AS rule,
               unnest([price_ok, discount_ok, tier_ok]) AS ok FROM dirty)
           WHERE NOT ok AND occurred_at > TIMESTAMP '2001-06-30' - INTERVAL 365 DAY AND occurred_at <= TIMESTAMP '2001-06-30'
           GROUP BY rule""",
    ),
    "gold_sales_by_era_platform": (("mart",), "SELECT * FROM mart"),
    "gold_console_lifecycle": (("life",), "SELECT * FROM life"),
    "gold_player_360": (("p360",), "SELECT * FROM p360"),
    "gold_title_performance": (
        ("ssales", "sev"),
        """SELECT * FROM (SELECT title, min(release_year)::INTEGER AS first_release_year, sum(global_sales_musd) AS units_m,
               sum(critic_score) / count(critic_score) AS avg_critic_score,
               sum(user_score::DECIMAL(18,4))::DOUBLE / count(user_score) AS avg_user_score FROM ssales GROUP BY title)
           FULL JOIN (SELECT title, sum(net_revenue::DECIMAL(18,4))::DOUBLE AS net_revenue, count(*) AS transactions,
               count(DISTINCT player_id) AS buyers, count(*) FILTER (is_preowned) / count(*) AS preowned_share
             FROM sev GROUP BY title) USING (title)""",
    ),
    "lookup_sales_by_era": (
        ("mart",),
        "SELECT era, console_family, channel_type, net_revenue, physical_units_m FROM mart WHERE console_family = 'Xbox'",
    ),
    "cdc_envelope_flatten": (("cdc",), "SELECT * EXCLUDE (batch) FROM cdc"),
    "cdc_last_writer": (
        ("cdc",),
        """SELECT _pk, batch, _lsn, _op, status, mrr FROM cdc
           QUALIFY row_number() OVER (PARTITION BY _pk, batch ORDER BY _lsn DESC) = 1""",
    ),
    "scd2_history": (("hist",), f"SELECT {HIST_COLUMNS} FROM hist"),
    "scd2_history_collapsed": (
        ("cdc",),
        f"""SELECT {HIST_COLUMNS} FROM (SELECT *, _op = 'd' AS is_deleted, _committed_at AS valid_from,
             lead(_committed_at) OVER w AS valid_to, lead(_lsn) OVER w IS NULL AS is_current
           FROM (SELECT * FROM cdc QUALIFY row_number() OVER (PARTITION BY _pk, batch ORDER BY _lsn DESC) = 1)
           WINDOW w AS (PARTITION BY _pk ORDER BY _lsn))""",
    ),
    "scd2_orders": (
        (),
        f"""SELECT *, lead(_committed_at) OVER w AS valid_to, lead(_lsn) OVER w IS NULL AS is_current FROM (
             SELECT o_orderkey::VARCHAR AS _pk, CASE s WHEN 0 THEN 'c' WHEN 2 THEN 'u' ELSE 'd' END AS _op,
               date_diff('day', DATE '1970-01-01', (o_orderdate + to_days(s))::DATE)::BIGINT * 10000000000000 + o_orderkey AS _lsn,
               o_orderdate + to_days(s) AS _committed_at, o_orderkey::VARCHAR AS order_id, o_custkey::VARCHAR AS player_id,
               'digital_store' AS channel_code, ({PLATFORMS})[o_orderkey % 12 + 1] AS platform,
               CASE s WHEN 0 THEN 'PLACED' ELSE 'SHIPPED' END AS order_status, o_totalprice::DECIMAL(18,2)::VARCHAR AS order_total,
               'EUR' AS currency, strftime(o_orderdate, '%Y-%m-%d') AS created_at, strftime(o_orderdate, '%Y-%m-%d') AS updated_at,
               s = 5 AS is_deleted, o_orderdate + to_days(s) AS valid_from
             FROM orders, (VALUES (0), (2), (5)) t(s) WHERE s < 5 OR o_orderkey % 7 = 0)
           WINDOW w AS (PARTITION BY _pk ORDER BY _lsn)""",
    ),
    "scd2_customers": (
        (),
        f"""SELECT *, lead(_committed_at) OVER w AS valid_to, lead(_lsn) OVER w IS NULL AS is_current FROM (
             SELECT o_custkey::VARCHAR AS _pk, CASE WHEN o_orderkey % 19 = 0 THEN 'd' ELSE 'u' END AS _op,
               date_diff('day', DATE '1970-01-01', o_orderdate::DATE)::BIGINT * 10000000000000 + o_orderkey AS _lsn,
               o_orderdate AS _committed_at, o_custkey::VARCHAR AS player_id, (['DE', 'FR', 'ES', 'US'])[o_orderkey % 4 + 1] AS country,
               strftime(o_orderdate, '%Y-%m-%d') AS signup_at, ({PLATFORMS})[o_orderkey % 12 + 1] AS primary_platform,
               o_orderkey % 19 = 0 AS is_deleted, o_orderdate AS valid_from FROM orders)
           WINDOW w AS (PARTITION BY _pk ORDER BY _lsn)""",
    ),
    "scd2_stream": (("hist",), f"SELECT {HIST_COLUMNS} FROM hist"),
    "scd2_current": (
        ("hist",),
        "SELECT _pk, _lsn, membership_tier, status, mrr FROM hist WHERE is_current AND NOT is_deleted",
    ),
    "scd2_as_of": (
        ("hist",),
        f"SELECT _pk, _lsn, status, valid_from, valid_to FROM hist WHERE {VALID_AT.format(t="TIMESTAMP '1999-06-30'")}",
    ),
    "scd2_point_in_time_join": (
        ("ev", "hist"),
        """SELECT event_id, occurred_at, 'S' || ev.player_id AS subscription_id, h._lsn, h.membership_tier, h.status
           FROM ev LEFT JOIN hist h ON h._pk = 'S' || ev.player_id AND h.valid_from <= ev.occurred_at
             AND (h.valid_to IS NULL OR h.valid_to > ev.occurred_at) AND NOT h.is_deleted""",
    ),
    "gold_membership_mrr": (
        ("hist",),
        """SELECT month, membership_tier, mrr::DOUBLE AS mrr, active_subs, churned_subs, prior::DOUBLE AS prior_mrr,
             (mrr - coalesce(prior, 0))::DOUBLE AS net_new_mrr,
             churned_subs / nullif(active_subs + churned_subs, 0) AS churn_rate
           FROM (SELECT *, lag(mrr) OVER (PARTITION BY membership_tier ORDER BY month) AS prior
             FROM (SELECT date_trunc('month', valid_from)::TIMESTAMP AS month, membership_tier,
               coalesce(sum(mrr::DECIMAL(18,4)) FILTER (status = 'ACTIVE'), 0) AS mrr,
               count(*) FILTER (status = 'ACTIVE') AS active_subs, count(*) FILTER (status = 'CANCELLED') AS churned_subs
               FROM hist GROUP BY ALL))""",
    ),
    "gold_membership_movements": (
        ("hist",),
        """SELECT date_trunc('month', valid_from)::TIMESTAMP AS month,
             count(*) FILTER (before_status <> 'ACTIVE') AS reactivated_subs,
             count(*) FILTER (before_status = 'ACTIVE' AND amount > before_amount) AS expanded_subs,
             coalesce(sum(amount - before_amount) FILTER (before_status = 'ACTIVE' AND amount > before_amount), 0)::DOUBLE AS expansion_mrr
           FROM (SELECT valid_from, status, mrr::DECIMAL(18,4) AS amount, lag(status) OVER w AS before_status,
             lag(mrr::DECIMAL(18,4)) OVER w AS before_amount FROM hist WINDOW w AS (PARTITION BY _pk ORDER BY _lsn))
           WHERE status = 'ACTIVE' AND before_status IS NOT NULL GROUP BY 1""",
    ),
    "append_dedup": (
        (),
        """SELECT o_custkey, o_orderdate, o_orderkey, o_orderstatus, o_totalprice FROM orders
           QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
    ),
    "change_feed": (
        ("hist",),
        f"""SELECT unnest(CASE WHEN a.subscription_id IS NULL THEN ['insert'] WHEN b.subscription_id IS NULL THEN ['delete']
               ELSE ['update_preimage', 'update_postimage'] END) AS _change_type,
             coalesce(a.subscription_id, b.subscription_id) AS subscription_id,
             unnest(CASE WHEN a.subscription_id IS NULL THEN [b.membership_tier] WHEN b.subscription_id IS NULL
               THEN [a.membership_tier] ELSE [a.membership_tier, b.membership_tier] END) AS membership_tier,
             unnest(CASE WHEN a.subscription_id IS NULL THEN [b.status] WHEN b.subscription_id IS NULL
               THEN [a.status] ELSE [a.status, b.status] END) AS status,
             unnest(CASE WHEN a.subscription_id IS NULL THEN [b.mrr] WHEN b.subscription_id IS NULL
               THEN [a.mrr] ELSE [a.mrr, b.mrr] END) AS mrr
           FROM (SELECT * FROM hist WHERE {VALID_AT.format(t="TIMESTAMP '1998-06-30'")}) a
           FULL JOIN (SELECT * FROM hist WHERE {VALID_AT.format(t="TIMESTAMP '1998-12-31'")}) b
             ON a.subscription_id = b.subscription_id
           WHERE (a.subscription_id IS NULL OR b.subscription_id IS NULL
             OR (a.membership_tier, a.status, a.mrr) IS DISTINCT FROM (b.membership_tier, b.status, b.mrr))""",
    ),
    "incremental_high_water": (
        (),
        """SELECT o_orderkey, date_diff('day', DATE '1970-01-01', o_orderdate::DATE)::BIGINT AS version,
             (CASE WHEN year(o_orderdate) <= 1998 THEN 1 ELSE 2 END)::INTEGER AS run FROM orders""",
    ),
    "schema_evolution_union": (
        ("ev",),
        """SELECT event_id, occurred_at, quantity, CASE WHEN year(occurred_at) >= 1998 THEN discount_pct END AS discount_pct,
             CASE WHEN year(occurred_at) >= 1998 THEN is_preowned END AS is_preowned FROM ev""",
    ),
    "rescued_data": (
        ("listing",),
        """SELECT ' ' || title AS Name, platform AS Platform, release_year AS Year, genre AS Genre, publisher AS Publisher,
             global_sales_musd AS Global_Sales,
             CASE WHEN release_year IS NULL THEN '{"Year":"N/A"}' END AS _rescued_data FROM listing""",
    ),
    "ingest_csv_incremental": (
        (),
        """SELECT c_custkey, c_name, CASE WHEN c_custkey % 6 <> 2 THEN c_nationkey END AS c_nationkey, c_acctbal, c_mktsegment,
             CASE WHEN c_custkey % 3 = 1 THEN c_mktsegment[:2] END AS c_code,
             CASE WHEN c_custkey % 6 = 2 THEN '{"c_nationkey":"N' || c_nationkey || '"}' END AS _rescued_data,
             'customers' AS _dataset_key, '2024-01-0' || (c_custkey % 3 + 1) AS landed FROM customer""",
    ),
    "publish_mart": (("life",), "SELECT * FROM life"),
    "clustered_write": (("ssales",), f"SELECT {SALES_COLUMNS} FROM ssales"),
    "compact_table": ((), "SELECT * FROM orders"),
    "stream_events_bronze": (
        ("good",),
        """SELECT event_id, player_id, platform, channel_code, occurred_at, quantity, unit_price, discount_pct,
             date_trunc('day', occurred_at)::TIMESTAMP AS event_date FROM good""",
    ),
    "stream_dedup": ((), "SELECT * FROM events"),
    "stream_restart": ((), "SELECT * FROM events"),
    "rt_revenue": (("slid",), "SELECT * FROM slid"),
    "rt_revenue_panes": (("slid",), "SELECT * FROM slid"),
    "stream_early_panes": (
        ("good",),
        """SELECT window_start, window_start + INTERVAL 60 SECOND AS window_end, platform, channel_code,
             sum(net_revenue::DECIMAL(18,4))::DOUBLE AS net_revenue, count(*) AS events
           FROM (SELECT *, time_bucket(INTERVAL 15 SECOND, occurred_at) - to_seconds(15 * i) AS window_start
             FROM good CROSS JOIN range(4) t(i)) GROUP BY ALL""",
    ),
    "late_data": (
        ("good",),
        """SELECT window_start, window_end, platform, channel_code, sum(net_revenue::DECIMAL(18,4))::DOUBLE AS net_revenue
           FROM (SELECT *, window_start + INTERVAL 60 SECOND AS window_end FROM (
             SELECT *, time_bucket(INTERVAL 15 SECOND, occurred_at) - to_seconds(15 * i) AS window_start
             FROM good CROSS JOIN range(4) t(i)))
           WHERE src_id % 10 <> 9 OR window_end + INTERVAL 300 SECOND
             > (SELECT max(occurred_at) FROM good WHERE src_id % 10 <> 9)
           GROUP BY window_start, window_end, platform, channel_code""",
    ),
    "stream_late_rows": (
        ("msg", "good"),
        """SELECT outcome, count(*) AS n FROM (
             SELECT CASE WHEN src_id % 10 <> 9 OR window_start + INTERVAL 360 SECOND
               > (SELECT max(occurred_at) FROM good WHERE src_id % 10 <> 9) THEN 'kept' ELSE 'late' END AS outcome
             FROM (SELECT *, time_bucket(INTERVAL 15 SECOND, occurred_at) - to_seconds(15 * i) AS window_start
               FROM good CROSS JOIN range(4) t(i))
             UNION ALL SELECT 'dead' FROM msg WHERE error IS NOT NULL) GROUP BY outcome""",
    ),
    "parse_with_dlq": (
        ("msg", "good"),
        """SELECT event_id, net_revenue, NULL::VARCHAR AS error FROM good
           UNION ALL SELECT NULL, NULL, error FROM msg WHERE error IS NOT NULL""",
    ),
    "json_props_extract": ((), "SELECT event_id, (props->>'$.k')::INTEGER AS k FROM events"),
    "stream_lag_report": (
        (),
        """SELECT event_type, floor(epoch(TIMESTAMP '2024-01-31' - max(ts)))::BIGINT AS lag_seconds, 900::INTEGER AS slo_seconds,
             floor(epoch(TIMESTAMP '2024-01-31' - max(ts))) > 900 AS breached FROM events GROUP BY event_type""",
    ),
    "feat_player": (("fplayer",), "SELECT * FROM fplayer"),
    "feat_interactions": (("inter",), "SELECT * FROM inter"),
    "feat_sales_ts": (("ts",), "SELECT * FROM ts"),
    "sequence_windows": (
        ("ts",),
        """SELECT platform_code, channel_type, ds AS last_ds, 56::INTEGER AS steps, 28::INTEGER AS targets,
             lag(r, 55) OVER w AS x_first, r AS x_last, lead(r, 1) OVER w AS y_first, lead(r, 28) OVER w AS y_last,
             round(sum(r) OVER (w ROWS BETWEEN 55 PRECEDING AND CURRENT ROW), 2) AS x_total
           FROM (SELECT *, revenue::FLOAT::DOUBLE AS r FROM ts)
           WINDOW w AS (PARTITION BY platform_code, channel_type ORDER BY ds)
           QUALIFY row_number() OVER w >= 56 AND lead(r, 29) OVER w IS NOT NULL""",
    ),
    "chronological_split": (("split",), "SELECT platform_code, channel_type, ds, revenue, split FROM split"),
    "recsys_training_set": (
        ("inter", "p360"),
        """SELECT player_id, product_id, pc AS player_code, ic AS item_code, confidence, is_churned
           FROM inter JOIN (SELECT player_id, is_churned FROM p360) USING (player_id)
           JOIN (SELECT player_id, row_number() OVER (ORDER BY md5(player_id), player_id) - 1 AS pc
             FROM (SELECT DISTINCT player_id FROM inter)) USING (player_id)
           JOIN (SELECT product_id, row_number() OVER (ORDER BY md5(product_id), product_id) - 1 AS ic
             FROM (SELECT DISTINCT product_id FROM inter)) USING (product_id)""",
    ),
    "churn_score_bands": (
        ("fplayer",),
        """SELECT player_id, p AS churn_probability, CASE WHEN p > 0.7 THEN 'HIGH' WHEN p > 0.4 THEN 'MEDIUM' ELSE 'LOW' END AS risk_band
           FROM (SELECT player_id, round(1 / (1 + exp(-(0.4 + 0.01 * recency_days::DOUBLE - 0.0002 * tenure_days::DOUBLE - 0.1 * log_ltv))), 6) AS p FROM fplayer)""",
    ),
    "lookup_player_churn": (
        ("fplayer",),
        """SELECT player_id, p AS churn_probability, CASE WHEN p > 0.7 THEN 'HIGH' WHEN p > 0.4 THEN 'MEDIUM' ELSE 'LOW' END AS risk_band
           FROM (SELECT player_id, round(1 / (1 + exp(-(0.4 + 0.01 * recency_days::DOUBLE - 0.0002 * tenure_days::DOUBLE - 0.1 * log_ltv))), 6) AS p FROM fplayer)
           WHERE player_id = '1'""",
    ),
    "lookup_pruned": (
        ("fplayer",),
        """SELECT lookup, CASE lookup WHEN 'player' THEN one ELSE len(list_filter(ps, lambda x: x >= cut)) END::BIGINT AS found,
             TRUE AS at_most_a_tenth_read
           FROM (SELECT count(*) FILTER (player_id = '1') AS one, list(p) AS ps, quantile_disc(p, 0.98) AS cut FROM (
             SELECT player_id, round(1 / (1 + exp(-(0.4 + 0.01 * recency_days::DOUBLE - 0.0002 * tenure_days::DOUBLE - 0.1 * log_ltv))), 6) AS p FROM fplayer))
           CROSS JOIN (VALUES ('player'), ('at_risk')) AS t(lookup)""",
    ),
    "churn_auc": (
        ("fplayer",),
        """SELECT (p + n)::BIGINT AS rows, p::BIGINT AS positives, CASE WHEN p > 0 AND n > 0 THEN round((t / (2.0::DOUBLE * p * n))::DOUBLE, 6) END AS auc
           FROM (SELECT sum(pos) AS p, sum(neg) AS n, sum(pos * (2 * below + neg))::DOUBLE AS t FROM (
             SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM (
               SELECT s, count(*) FILTER (is_churned = 1) AS pos, count(*) FILTER (is_churned <> 1) AS neg FROM (
                 SELECT is_churned, round(1 / (1 + exp(-(0.4 + 0.01 * recency_days::DOUBLE - 0.0002 * tenure_days::DOUBLE - 0.1 * log_ltv))), 6) AS s FROM fplayer)
               WHERE s IS NOT NULL AND is_churned IS NOT NULL GROUP BY s)))""",
    ),
    "churn_model": (("p360",), "SELECT player_id, TRUE AS scored FROM p360"),
    "recommend_als": (
        ("inter",),
        """SELECT player_id, least(10, titles - own)::BIGINT AS items, least(10, titles - own)::BIGINT AS last_rank, least(10, titles - own)::BIGINT AS titles
           FROM (SELECT player_id, count(DISTINCT product_id) AS own, (SELECT count(DISTINCT product_id) FROM inter) AS titles
               FROM inter GROUP BY player_id) WHERE own < titles""",
    ),
    "forecast_model": (
        ("split",),
        "SELECT platform_code, channel_type, ds, revenue, TRUE AS made FROM split WHERE split = 'validation'",
    ),
    "embedding_lsh": ((), "SELECT DISTINCT label::BIGINT AS query_id, TRUE AS exact, TRUE AS half_found FROM embeddings"),
    "embedding_cells": (
        (),
        """SELECT query_id, least(10, (SELECT count(*) FROM embeddings)) AS matches, vec_id AS nearest_id, similarity, TRUE AS recall_reached
           FROM (SELECT q.vec_id AS query_id, e.vec_id, round(list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]), 6) AS similarity
             FROM embeddings q CROSS JOIN embeddings e WHERE q.vec_id % 50 = 0)
           QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, vec_id) = 1""",
    ),
    "recall_at_k": (("recall",), "SELECT relevant, hits, recall FROM recall WHERE m = 'purchases'"),
    "promotion_gate": (
        ("recall",),
        """SELECT champion, challenger, round(challenger - champion, 6) AS delta, round(challenger - champion, 6) >= 0.01 AS promote
           FROM (SELECT max(recall) FILTER (m = 'purchases') AS champion, max(recall) FILTER (m = 'spend') AS challenger FROM recall)""",
    ),
    "forecast_baseline": (
        ("split",),
        "SELECT platform_code, channel_type, ds, revenue, revenue_lag_28 AS forecast FROM split WHERE split = 'validation'",
    ),
    "forecast_errors": (
        ("split",),
        """SELECT platform_code, channel_type, count(*) AS n, round(avg(abs(e)), 4) AS mae, round(sqrt(avg(e * e)), 4) AS rmse,
             round(avg(CASE WHEN abs(e) <= 1 THEN 0.5 * e * e ELSE abs(e) - 0.5 END), 4) AS huber
           FROM (SELECT *, revenue - revenue_lag_28 AS e FROM split WHERE split = 'validation') GROUP BY ALL""",
    ),
    "enrichment_todo": (("todo",), "SELECT * FROM todo"),
    "catalog_enrich": (
        ("todo",),
        """SELECT title, platform_code, era, genre, publisher, reject_reason,
             CASE WHEN reject_reason IS NULL THEN 'g' || n % 5 END AS sub_genre,
             CASE WHEN reject_reason IS NULL THEN (['LOW', 'MEDIUM', 'HIGH'])[n % 4 + 1] END AS retro_appeal
           FROM (SELECT *, CASE WHEN n % 7 = 0 THEN 'invalid json' WHEN n % 4 = 3 THEN 'invalid retro_appeal' END AS reject_reason
             FROM (SELECT *, length(title) AS n FROM todo))""",
    ),
    "llm_json_validate": (
        (),
        """SELECT p_partkey, reject_reason, CASE WHEN reject_reason IS NULL THEN p_type END AS sub_genre,
             CASE WHEN reject_reason IS NULL THEN (['LOW', 'MEDIUM', 'HIGH'])[p_size % 4 + 1] END AS retro_appeal
           FROM (SELECT *, CASE WHEN p_size % 10 = 0 THEN 'invalid json' WHEN p_size % 10 = 1 THEN 'no completion'
             WHEN p_size % 4 = 3 THEN 'invalid retro_appeal' END AS reject_reason FROM part)""",
    ),
    "catalog_document_text": (("docs",), "SELECT p_partkey, document FROM docs"),
    "catalog_embed": (
        ("docs",),
        """SELECT title, platform_code, 6::INTEGER AS dims,
             (length(document) - length(translate(document, 'aeiou ', '')))::DOUBLE AS total FROM docs""",
    ),
    "catalog_term_vectors": (
        ("docs",),
        """SELECT title, platform_code, 256::INTEGER AS dims, 1.0::DOUBLE AS norm,
             len(regexp_extract_all(lower(document), '[a-z0-9]+'))::INTEGER AS n_terms FROM docs""",
    ),
    "embedding_topk": (
        (),
        """WITH c AS (SELECT label, list(v ORDER BY pos) AS q FROM (SELECT label, pos, avg(v::DOUBLE) AS v
               FROM (SELECT label, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS pos FROM embeddings)
               GROUP BY label, pos) GROUP BY label)
           SELECT label::BIGINT AS query_id, vec_id, similarity, rank FROM (
             SELECT label, vec_id, similarity,
               row_number() OVER (PARTITION BY label ORDER BY similarity DESC, vec_id)::INTEGER AS rank
             FROM (SELECT c.label, vec_id, round(list_cosine_similarity(embedding::DOUBLE[], q), 6) AS similarity
               FROM embeddings CROSS JOIN c)) WHERE rank <= 10""",
    ),
}


def _needed(names: tuple[str, ...], seen: list[str]) -> list[str]:
    for name in names:
        _needed(CTES[name][0], seen)
        if name not in seen:
            seen.append(name)
    return seen


def oracle_sql() -> dict[str, str]:
    out = {}
    for key, (ctes, body) in SELECTS.items():
        parts = ",\n".join(f"{n} AS ({CTES[n][1]})" for n in _needed(ctes, []))
        out[key] = f"WITH {parts}\n{body}" if parts else body
    return out
