"""The same results in DuckDB SQL over the test tables."""

from __future__ import annotations

from reelgauge import fixed_values as fixed

YEARS = (1998, 1999, 2000)

_VIDEOS = """
v AS MATERIALIZED (
  SELECT concat('v', o_orderkey) AS video_id,
    concat(array_to_string([x FOR x, i IN string_split(text, chr(10))
             IF (i - 1) % per_document = (o_orderkey // n_documents) % per_document], ' '),
           CASE WHEN o_orderkey % 7 = 0 THEN ' 😀' ELSE '' END) AS title,
    concat('c', n_nationkey) AS channel_id, n_name AS channel_name, r_name AS niche,
    o_orderdate + to_hours(cast(o_orderkey % 24 AS INTEGER)) AS published_at,
    CASE WHEN o_orderkey % 101 = 0 THEN NULL
         ELSE concat('PT', (o_orderkey * 37) % 7200 // 60, 'M', (o_orderkey * 37) % 7200 % 60, 'S') END AS duration,
    CASE WHEN o_orderkey % 3 = 0 THEN 'sd' ELSE 'hd' END AS definition,
    CASE WHEN o_orderkey % 50 = 0 THEN 0 WHEN o_orderkey % 97 = 0 THEN cast(floor(o_totalprice) AS BIGINT) * 100
         ELSE cast(floor(o_totalprice) AS BIGINT) END AS view_count,
    (o_orderkey * 7919) % 5000 AS like_count,
    (o_orderkey * 104729) % 700 AS comment_count,
    concat('https://img.example/v', o_orderkey, '.jpg') AS thumbnail_url,
    concat('2024-01-', lpad(cast(1 + o_orderkey % 28 AS VARCHAR), 2, '0')) AS extraction_date,
    (o_orderkey * 7919) % 5000 = 0 AS like_count_missing,
    (o_orderkey * 104729) % 700 = 0 AS comment_count_missing
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  CROSS JOIN (SELECT n_documents, greatest(1, n_orders // n_documents) AS per_document
    FROM (SELECT count(*) AS n_documents FROM documents), (SELECT count(*) AS n_orders FROM orders))
  JOIN documents ON doc_id = o_orderkey % n_documents
)"""

_SILVER = """
s AS MATERIALIZED (
  SELECT * REPLACE (
      cast(regexp_extract(duration, 'PT([0-9]+)M', 1) AS DOUBLE) * 60
        + cast(regexp_extract(duration, 'M([0-9]+)S', 1) AS DOUBLE) AS duration),
    dayname(published_at) AS dia_semana,
    cast(isodow(published_at) - 1 AS INTEGER) AS day_number,
    cast(hour(published_at) AS INTEGER) AS hora_publicacao,
    cast(month(published_at) AS INTEGER) AS mes,
    cast(year(published_at) AS INTEGER) AS ano,
    cast(day(published_at) AS INTEGER) AS dia,
    cast(weekofyear(published_at) AS INTEGER) AS semana_do_ano,
    cast(isoyear(published_at) AS INTEGER) AS ano_da_semana,
    strftime(published_at, '%Y-%m') AS ano_mes_publish,
    CASE WHEN view_count > 0 THEN (like_count + comment_count) / view_count * 100 END AS engagement_rate,
    CASE WHEN view_count > 0 THEN like_count / view_count * 100 END AS like_ratio,
    CASE WHEN view_count > 0 THEN comment_count / view_count * 100 END AS comment_ratio
  FROM v
),
w AS MATERIALIZED (
  SELECT *, CASE WHEN duration > CASE WHEN niche = 'EUROPE' THEN 3600 ELSE 90 END THEN 'long'
                 WHEN duration <= CASE WHEN niche = 'EUROPE' THEN 3600 ELSE 90 END THEN 'short'
            END AS length_class
  FROM s
)"""


def _over(body: str, *more: str) -> str:
    """A query over ``w``, the frame with niche and length class."""
    return "WITH " + ",".join([_VIDEOS, _SILVER, *more]) + "\n" + body


def _beta_tail(a: str, b: str, x: str, y: str) -> str:
    """I_x(a, b) with y = 1 - x, by the series of the smaller side."""
    def series(p: str, q: str, z: str) -> str:
        # z^p (1-z)^q / (p B(p,q)) * sum of (p+q)_n / (p+1)_n z^n
        return (
            f"list_sum([exp(lgamma({p} + {q} + n) - lgamma({p} + 1 + n) - lgamma({q})"
            f" + ({p} + n) * ln({z}) + {q} * ln(1 - {z})) FOR n IN range(3000)])"
        )

    return (
        f"CASE WHEN {y} <= 0 THEN 1.0 WHEN {y} <= 0.5 THEN 1 - {series(b, a, y)}"
        f" ELSE {series(a, b, x)} END"
    )


def _p_of_t(table: str, t: str = "t_stat", df: str = "df") -> str:
    """CTE body adding p_value and significant to a table with t and df."""
    tail = _beta_tail("a", "0.5", "x", "y")
    return f"""
  SELECT * EXCLUDE (a, x, y), p_value < 0.05 AS significant FROM (
    SELECT *, {tail} AS p_value FROM (
      SELECT *, {df} / 2.0 AS a, {df} / ({df} + {t} * {t}) AS x, {t} * {t} / ({df} + {t} * {t}) AS y
      FROM {table}))"""


_WELCH = """
    CASE WHEN va / na + vb / nb > 0 THEN (ma - mb) / sqrt(va / na + vb / nb) END AS t_stat,
    CASE WHEN va / na + vb / nb > 0 THEN (va / na + vb / nb) ** 2
      / ((va / na) ** 2 / (na - 1) + (vb / nb) ** 2 / (nb - 1)) END AS df"""

_BINS = ", ".join(
    f"({no}, {low}, {high}, '{label}')" for no, (low, high, label) in enumerate(fixed.TITLE_LENGTH_BINS, 1)
)
_DAYS = ", ".join(f"({no}, '{label}')" for no, label in enumerate(fixed.WEEKDAYS_PT.values()))
_STOP = ", ".join(f"'{word}'" for word in fixed.STOPWORDS)
# Fixed values, written out so that a wrong range in the package shows.
_EMOJI = (
    "["
    r"\x{1F600}-\x{1F64F}"
    r"\x{1F300}-\x{1F5FF}"
    r"\x{1F680}-\x{1F6FF}"
    r"\x{1F700}-\x{1F77F}"
    r"\x{1F780}-\x{1F7FF}"
    r"\x{1F800}-\x{1F8FF}"
    r"\x{1F900}-\x{1F9FF}"
    r"\x{1FA00}-\x{1FA6F}"
    r"\x{1FA70}-\x{1FAFF}"
    r"\x{2702}-\x{27B0}"
    r"\x{24C2}-\x{1F251}"
    "]"
)

_BIN_STATS = f"""
bins AS (SELECT * FROM (VALUES {_BINS}) AS t(bin_no, low, high, label)),
perf AS (
  SELECT n.niche, bin_no, label, avg(view_count) AS avg_views, avg(like_count) AS avg_likes,
    avg(engagement_rate) AS avg_engagement, count(video_id) AS count
  FROM (SELECT DISTINCT niche FROM w) n CROSS JOIN bins
  LEFT JOIN w ON w.niche = n.niche AND length(title) > low AND length(title) <= high
  GROUP BY ALL
)"""

_WORDS = f"""
q AS (SELECT niche, quantile_cont(view_count, 0.75) AS q75 FROM w GROUP BY niche),
tokens AS (
  SELECT niche, unnest(regexp_extract_all(lower(title), '[\\p{{L}}\\p{{N}}_]+')) AS word
  FROM w JOIN q USING (niche) WHERE view_count >= q75
),
counts AS (
  SELECT niche, word, count(*) AS n FROM tokens
  WHERE regexp_full_match(word, '[{fixed.WORD_LETTERS}]{{{fixed.WORD_MIN_LENGTH},}}')
    AND word NOT IN ({_STOP})
  GROUP BY niche, word
),
ranked AS (
  SELECT *, cast(row_number() OVER (PARTITION BY niche ORDER BY n DESC, word) AS INTEGER) AS rank FROM counts
)"""

_KEYWORD = f"""
kw AS (
  SELECT w.niche, rank, word AS keyword, contains(lower(title), word) AS held,
    view_count, like_count, engagement_rate
  FROM w JOIN ranked ON w.niche = ranked.niche AND rank <= {fixed.TOP_WORDS}
),
kw_stats AS (
  SELECT niche, rank, keyword,
    count(*) FILTER (held) AS na, count(*) FILTER (NOT held) AS nb,
    avg(view_count) FILTER (held) AS ma, avg(view_count) FILTER (NOT held) AS mb,
    avg(like_count) FILTER (held) AS la, avg(like_count) FILTER (NOT held) AS lb,
    avg(engagement_rate) FILTER (held) AS ea, avg(engagement_rate) FILTER (NOT held) AS eb,
    var_samp(view_count) FILTER (held) AS va, var_samp(view_count) FILTER (NOT held) AS vb
  FROM kw GROUP BY ALL
),
kw_t AS (SELECT *, {_WELCH} FROM kw_stats),
kw_p AS ({_p_of_t("kw_t")})"""

_EMOJI_STATS = f"""
em AS (SELECT *, regexp_matches(title, '{_EMOJI}') AS flag FROM w),
em_stats AS (
  SELECT niche, avg(cast(flag AS INTEGER)) * 100 AS emoji_percentage,
    count(*) FILTER (flag) AS na, count(*) FILTER (NOT flag) AS nb,
    avg(view_count) FILTER (flag) AS ma, avg(view_count) FILTER (NOT flag) AS mb,
    avg(like_count) FILTER (flag) AS la, avg(like_count) FILTER (NOT flag) AS lb,
    avg(engagement_rate) FILTER (flag) AS ea, avg(engagement_rate) FILTER (NOT flag) AS eb,
    var_samp(view_count) FILTER (flag) AS va, var_samp(view_count) FILTER (NOT flag) AS vb
  FROM em GROUP BY niche
),
em_t AS (SELECT *, {_WELCH} FROM em_stats),
em_p AS ({_p_of_t("em_t")})"""

_DAY_STATS = f"""
days AS (SELECT * FROM (VALUES {_DAYS}) AS t(day_number, label)),
wd AS (
  SELECT niche, dia_semana AS day_of_week, day_number, label AS day_of_week_pt,
    avg(view_count) AS media_views, cast(sum(view_count) AS BIGINT) AS total_views,
    count(*) AS count_videos, avg(engagement_rate) AS media_engagement
  FROM w JOIN days USING (day_number) GROUP BY ALL
)"""

_LENGTH_BEST = """
lb AS (
  SELECT niche, first(label ORDER BY avg_views DESC NULLS LAST, bin_no) AS best_views_length,
    max(avg_views) AS best_avg_views,
    first(label ORDER BY avg_engagement DESC NULLS LAST, bin_no) AS best_engagement_length,
    max(avg_engagement) AS best_avg_engagement
  FROM perf GROUP BY niche
)"""

_BEST_DAY = """
bd AS (
  SELECT niche, first(day_of_week_pt ORDER BY media_views DESC, day_number) AS best_day_pt,
    max(media_views) AS best_media_views,
    first(day_of_week_pt ORDER BY media_views, day_number) AS worst_day_pt,
    min(media_views) AS worst_media_views
  FROM wd GROUP BY niche
)"""

_RATIO = """
ra AS (
  SELECT niche,
    avg(view_count) FILTER (length_class = 'short') / avg(view_count) FILTER (length_class = 'long') AS view_ratio,
    avg(engagement_rate) FILTER (length_class = 'short')
      / avg(engagement_rate) FILTER (length_class = 'long') AS engagement_ratio
  FROM w GROUP BY niche
)"""

_RATIO_COLUMNS = """round(view_ratio, 6) AS view_ratio, round(engagement_ratio, 6) AS engagement_ratio,
  coalesce(view_ratio > 1.5 AND engagement_ratio > 1.2, false) AS favour_shorts"""

_MONTHS = """
mo AS (
  SELECT niche, ano, mes, make_date(ano, mes, 1) AS date, count(*) AS num_videos,
    avg(view_count) AS media_views, cast(sum(view_count) AS BIGINT) AS total_views,
    avg(engagement_rate) AS media_engagement, avg(like_count) AS media_likes
  FROM w GROUP BY ALL
)"""

_SCATTER = """
long AS (SELECT *, duration / 60 AS duration_minutes FROM w WHERE length_class = 'long'),
lim AS (
  SELECT niche, quantile_cont(duration_minutes, 0.99) AS ml, quantile_cont(view_count, 0.99) AS vl
  FROM long GROUP BY niche
),
sc AS (SELECT long.* FROM long JOIN lim USING (niche) WHERE duration_minutes < ml AND view_count < vl)"""


def _box(value: str) -> str:
    return f"""
bx AS (
  SELECT niche, length_class,
    quantile_cont({value}, 0.0) AS min, quantile_cont({value}, 0.25) AS q1,
    quantile_cont({value}, 0.5) AS median, quantile_cont({value}, 0.75) AS q3,
    quantile_cont({value}, 1.0) AS max
  FROM w WHERE length_class IS NOT NULL GROUP BY ALL
),
mk AS (
  SELECT w.niche, w.length_class, video_id, {value}, bx.* EXCLUDE (niche, length_class),
    {value} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
  FROM w JOIN bx ON w.niche = bx.niche AND w.length_class = bx.length_class
)"""



def _year_columns() -> str:
    parts = []
    for year in YEARS:
        of = f"FILTER (ano = {year})"
        parts += [
            f"cast(sum(view_count) {of} AS BIGINT) AS total_views_{year}",
            f"cast(sum(like_count) {of} AS BIGINT) AS total_likes_{year}",
            f"cast(sum(comment_count) {of} AS BIGINT) AS total_comments_{year}",
            f"round(avg(engagement_rate) {of}, 6) AS avg_engagement_rate_{year}",
            f"round(CASE WHEN sum(view_count) {of} > 0 THEN sum(like_count + comment_count)"
            f" FILTER (ano = {year} AND view_count > 0) / sum(view_count) {of} * 100 END, 6)"
            f" AS weighted_engagement_rate_{year}",
        ]
    return ", ".join(parts)


def _record(name: str, order: str, shown: str, where: str = "true") -> str:
    pick = f"ORDER BY {order}, video_id"
    return (
        f"first(title {pick}) FILTER ({where}) AS {name}_title,"
        f" first(channel_name {pick}) FILTER ({where}) AS {name}_channel, {shown}"
    )


def _records() -> str:
    parts = [
        _record("first", "published_at", "strftime(min(published_at), '%d/%m/%Y') AS first_date"),
        _record("views", "view_count DESC", "max(view_count) AS views"),
        _record(
            "long_views",
            "view_count DESC",
            "max(view_count) FILTER (length_class = 'long') AS long_views",
            "length_class = 'long'",
        ),
        _record("likes", "like_count DESC", "max(like_count) AS likes"),
        _record("comments", "comment_count DESC", "max(comment_count) AS comments"),
        _record(
            "longest",
            "duration DESC NULLS LAST",
            "concat(cast(max(duration) AS BIGINT) // 3600, 'h ', cast(max(duration) AS BIGINT) % 3600 // 60,"
            " 'm ', cast(max(duration) AS BIGINT) % 60, 's') AS longest_duration",
        ),
        _record(
            "engagement",
            "engagement_rate DESC NULLS LAST",
            "round(max(engagement_rate), 6) AS engagement_rate",
        ),
    ]
    per_channel = """
ch AS (SELECT niche, channel_name, count(*) AS n FROM w GROUP BY ALL),
busy AS (
  SELECT niche, first(channel_name ORDER BY n DESC, channel_name) AS channel, max(n) AS n FROM ch GROUP BY niche
),
mn AS (SELECT niche, count(DISTINCT ano_mes_publish) AS months FROM w GROUP BY niche)"""
    body = f"""
SELECT r.*, channel AS most_videos_channel, n AS most_videos,
  channel AS most_per_month_channel, round(n / months, 6) AS most_per_month
FROM (SELECT niche, {", ".join(parts)} FROM w GROUP BY niche) r JOIN busy USING (niche) JOIN mn USING (niche)"""
    return _over(body, per_channel)


def _welch_long_short() -> str:
    metrics = {
        "avg_views": "view_count",
        "avg_likes": "like_count",
        "avg_comments": "comment_count",
        "avg_engagement": "engagement_rate",
    }
    unions = " UNION ALL ".join(
        f"""SELECT niche, '{metric}' AS metric,
    count({c}) FILTER (length_class = 'long') AS na, count({c}) FILTER (length_class = 'short') AS nb,
    avg({c}) FILTER (length_class = 'long') AS ma, avg({c}) FILTER (length_class = 'short') AS mb,
    var_samp({c}) FILTER (length_class = 'long') AS va, var_samp({c}) FILTER (length_class = 'short') AS vb
  FROM w GROUP BY niche"""
        for metric, c in metrics.items()
    )
    return _over(
        """SELECT niche, metric, na AS n_long, round(ma, 6) AS mean_long, nb AS n_short,
  round(mb, 6) AS mean_short, round(t_stat, 6) AS t_stat, round(df, 6) AS df,
  round(p_value, 6) AS p_value, significant FROM p""",
        f"u AS ({unions})",
        f"t AS (SELECT *, {_WELCH} FROM u)",
        f"p AS ({_p_of_t('t')})",
    )


def _density() -> str:
    return _over(
        """SELECT b.niche, b.length_class, b.bin, round(b.bin / 10, 6) AS bin_start, b.n,
  round(b.n / h.total, 6) AS share, round(sum(
    o.n / h.total * exp(-(((b.bin - o.bin) / 10 / width) ** 2) / 2) / (width * sqrt(2 * pi()))), 6) AS density
FROM b JOIN h ON b.niche = h.niche AND b.length_class = h.length_class
JOIN b o ON b.niche = o.niche AND b.length_class = o.length_class
GROUP BY b.niche, b.length_class, b.bin, b.n, h.total""",
        """l AS (SELECT niche, length_class, log10(greatest(view_count, 1)) AS x FROM w
  WHERE length_class IS NOT NULL)""",
        """b AS (SELECT niche, length_class, cast(floor(x * 10) AS BIGINT) AS bin, count(*) AS n FROM l
  GROUP BY ALL)""",
        """h AS (SELECT niche, length_class, count(*) AS total,
  1.059 * stddev_samp(x) * count(*) ** -0.2 AS width FROM l GROUP BY ALL)""",
    )


def _anova() -> str:
    tail = _beta_tail("a", "b", "x", "y")
    return _over(
        f"""SELECT niche, n_groups, n, round(f_stat, 6) AS f_stat, round(p_value, 6) AS p_value,
  p_value < 0.05 AS significant
FROM (SELECT *, {tail} AS p_value FROM (
  SELECT *, (n - n_groups) / 2.0 AS a, (n_groups - 1) / 2.0 AS b,
    (n - n_groups) / (n - n_groups + (n_groups - 1) * f_stat) AS x,
    (n_groups - 1) * f_stat / (n - n_groups + (n_groups - 1) * f_stat) AS y
  FROM f))""",
        """g AS (SELECT niche, dia_semana, count(*) AS k, avg(view_count) AS m, var_samp(view_count) AS v
  FROM w GROUP BY ALL)""",
        "gm AS (SELECT niche, avg(view_count) AS grand FROM w GROUP BY niche)",
        """f AS (SELECT niche, count(*) AS n_groups, cast(sum(k) AS BIGINT) AS n,
  (sum(k * (m - grand) ** 2) / (count(*) - 1)) / (sum((k - 1) * v) / (sum(k) - count(*))) AS f_stat
  FROM g JOIN gm USING (niche) GROUP BY niche)""",
    )


def _length_correlation() -> str:
    unions = " UNION ALL ".join(
        f"""SELECT niche, '{target}' AS target, count({c}) AS n, corr(length(title), {c}) AS r
  FROM w GROUP BY niche"""
        for target, c in {"views": "view_count", "engagement": "engagement_rate"}.items()
    )
    return _over(
        """SELECT niche, target, n, round(r, 6) AS r, round(t_stat, 6) AS t_stat,
  round(p_value, 6) AS p_value, significant FROM p""",
        f"u AS ({unions})",
        "t AS (SELECT *, r * sqrt((n - 2) / (1 - r * r)) AS t_stat, n - 2 AS df FROM u)",
        f"p AS ({_p_of_t('t')})",
    )


def _trend() -> str:
    unions = " UNION ALL ".join(
        f"SELECT niche, date, i, '{metric}' AS metric, cast({metric} AS DOUBLE) AS value FROM numbered"
        for metric in ["num_videos", "media_views", "total_views", "media_engagement", "media_likes"]
    )
    return _over(
        """SELECT niche, date, cast(i AS INTEGER) AS month_index, metric, round(value, 6) AS value,
  round(slope, 6) AS slope, round(intercept, 6) AS intercept, round(intercept + slope * i, 6) AS fitted
FROM u JOIN (SELECT niche, metric, regr_slope(value, i) AS slope, regr_intercept(value, i) AS intercept
             FROM u GROUP BY ALL) USING (niche, metric)""",
        _MONTHS,
        """numbered AS (SELECT *, row_number() OVER (PARTITION BY niche ORDER BY ano, mes) - 1 AS i
  FROM mo)""",
        f"u AS ({unions})",
    )


def all_queries() -> dict[str, str]:
    silver_columns = """video_id, title, channel_id, channel_name, published_at, round(duration, 6) AS duration,
  definition, view_count, like_count, comment_count, thumbnail_url, extraction_date,
  like_count_missing, comment_count_missing, dia_semana, hora_publicacao, mes, ano, dia,
  semana_do_ano, ano_da_semana, ano_mes_publish, round(engagement_rate, 6) AS engagement_rate,
  round(like_ratio, 6) AS like_ratio, round(comment_ratio, 6) AS comment_ratio"""
    found = {
        "bronze_channels": _over("""
SELECT concat('c', n_nationkey) AS channel_id, n_name AS channel_name, concat('@', lower(n_name)) AS custom_url,
  cast(concat('20', lpad(cast(n_nationkey % 20 AS VARCHAR), 2, '0'), '-03-15 10:20:30') AS TIMESTAMP) AS dt_published,
  CASE WHEN n_nationkey % 3 <> 0 THEN substring(n_name, 1, 2) END AS country,
  cast(sum(view_count) AS BIGINT) AS total_view,
  cast(CASE WHEN n_nationkey % 7 = 0 OR n_nationkey % 5 = 0 THEN 0 ELSE n_nationkey * 1000 END AS BIGINT)
    AS total_subscriber,
  count(*) AS total_video, concat('UU', n_nationkey) AS playlist
FROM nation JOIN v ON v.channel_id = concat('c', n_nationkey) GROUP BY n_nationkey, n_name"""),
        "bronze_videos": _over("SELECT * EXCLUDE (niche) FROM v"),
        "silver_videos": _over(f"SELECT {silver_columns} FROM s"),
        "json_scan_videos": _over("SELECT * EXCLUDE (niche) FROM v"),
        "rejects": """
SELECT reason, count(*) AS n FROM (
  SELECT CASE WHEN o_orderkey % 211 = 0 THEN 'unreadable' WHEN o_orderkey % 223 = 0 THEN 'no id'
    WHEN o_orderkey % 227 = 0 THEN CASE WHEN o_orderkey % 101 <> 0 THEN 'duration' END
    WHEN o_orderkey % 229 = 0 THEN 'published_at' END AS reason
  FROM orders) WHERE reason IS NOT NULL GROUP BY reason""",
        "csv_round_trip": _over("SELECT video_id, channel_name, view_count, extraction_date FROM v"),
        "landing_dates": _over("SELECT extraction_date, count(*) AS n FROM v GROUP BY ALL"),
        "silver_rebuild": _over("SELECT ano, count(*) AS n FROM s WHERE ano > 1995 GROUP BY ALL"),
        "overview_chosen": _over("""
SELECT niche, length_class, ano_mes_publish, count(*) AS n_videos, cast(sum(view_count) AS BIGINT) AS total_views
FROM w WHERE length_class IS NOT NULL AND channel_name IN ('FRANCE', 'CHINA', 'KENYA') GROUP BY ALL"""),
        "suggestions_append": """
SELECT c_name AS channel_name, c_mktsegment AS dashboard FROM customer WHERE c_mktsegment <> 'BUILDING'""",
        "id_batches": _over("""
SELECT channel_id, (rn - 1) // 50 AS batch_no, string_agg(video_id, ',' ORDER BY video_id) AS ids,
  cast(count(*) AS INTEGER) AS n_ids
FROM (SELECT channel_id, video_id,
        row_number() OVER (PARTITION BY channel_id ORDER BY md5(video_id), video_id) AS rn FROM v)
GROUP BY ALL"""),
        "id_batches_global": _over("""
SELECT (rn - 1) // 50 AS batch_no, string_agg(video_id, ',' ORDER BY video_id) AS ids, cast(count(*) AS INTEGER) AS n_ids
FROM (SELECT video_id, row_number() OVER (ORDER BY video_id) AS rn FROM v) GROUP BY ALL"""),
        "bronze_increment": _over("""
SELECT video_id, title, round(duration, 6) AS duration, ano, view_count,
  CASE WHEN view_count > 0 THEN round((like_count + comment_count) / view_count * 100, 6) END AS engagement_rate, extraction_date
FROM (
  SELECT * REPLACE (
      CASE WHEN third <> 1 THEN cast('1' || view_count AS BIGINT) ELSE view_count END AS view_count,
      CASE WHEN third <> 1 THEN '2024-02-02' ELSE '2024-02-01' END AS extraction_date)
  FROM (SELECT *, cast(substr(video_id, 2) AS BIGINT) % 3 AS third FROM s))"""),
        "dedupe_videos": """
SELECT video_id, extraction_date, channel_id, view_count FROM (
  SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY extraction_date, channel_id, view_count) AS rn
  FROM (SELECT concat('v', l_orderkey) AS video_id, strftime(l_shipdate, '%Y-%m-%d') AS extraction_date,
          concat('c', l_suppkey) AS channel_id, cast(floor(l_extendedprice) AS BIGINT) AS view_count
        FROM lineitem))
WHERE rn = 1""",
        "harvest_stats": """
SELECT (SELECT count(DISTINCT l_suppkey) FROM lineitem) AS channels_processed,
  (SELECT count(*) FROM lineitem) AS total_videos_found,
  count(*) AS videos_with_details, count(DISTINCT l_orderkey) AS processed_video_ids,
  strftime(max(l_shipdate), '%Y-%m-%d') AS extraction_date
FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey)""",
        "explode_items": _over("SELECT channel_id, video_id FROM v"),
        "page_chains": _over("""
SELECT k.playlist, k.token, k.next, k.copies, length - steps AS position,
  CASE WHEN f.goal IS NULL THEN 'loop' WHEN begun AND missing IS NULL THEN 'complete' WHEN begun THEN 'cut' ELSE 'orphan' END AS status,
  missing
FROM k LEFT JOIN f USING (playlist, token) LEFT JOIN g USING (playlist, goal)""", """
b AS (
  SELECT channel_id, no, max(no) OVER (PARTITION BY channel_id) AS last FROM (
    SELECT channel_id, (row_number() OVER (PARTITION BY channel_id ORDER BY md5(video_id), video_id) - 1) // 5 AS no FROM v)
  GROUP BY channel_id, no
),
k AS MATERIALIZED (
  SELECT channel_id AS playlist, CASE WHEN no = 0 THEN '' ELSE md5(channel_id || '-' || no) END AS token,
    CASE WHEN no < last THEN md5(channel_id || '-' || (no + 1))
      WHEN cast(substr(channel_id, 2) AS INTEGER) % 5 = 0 THEN md5(channel_id || '-1') END AS next,
    CASE WHEN no % 4 = 0 THEN 2 ELSE 1 END AS copies
  FROM b WHERE no % 11 <> 7
),
f AS (
  SELECT playlist, token, token AS goal, 0 AS steps, next AS missing FROM k
  WHERE next IS NULL OR NOT EXISTS (SELECT 1 FROM k z WHERE z.playlist = k.playlist AND z.token = k.next)
  UNION ALL SELECT k.playlist, k.token, f.goal, f.steps + 1, f.missing FROM f JOIN k ON k.playlist = f.playlist AND k.next = f.token
),
g AS (SELECT playlist, goal, max(steps) AS length, bool_or(token = '') AS begun FROM f GROUP BY ALL)""").replace(
            "WITH \n", "WITH RECURSIVE \n", 1),
        "niche_videos": _over("""
SELECT niche, video_id, channel_id FROM v
UNION SELECT 'ASIA', video_id, channel_id FROM v WHERE channel_id LIKE '%7'"""),
        "niche_filter": _over("SELECT video_id, channel_id, view_count FROM v WHERE niche = 'EUROPE'"),
        "length_class": _over("SELECT niche, video_id, round(duration, 6) AS duration, length_class FROM w"),
        "gold_cube": _over("""
SELECT niche, ano, length_class, count(*) AS n_videos, cast(sum(view_count) AS BIGINT) AS total_views,
  max(view_count) AS max_views, count(view_count) AS n_views, round(avg(view_count), 6) AS mean_views,
  round(stddev_samp(view_count), 6) AS sd_views, count(engagement_rate) AS n_rate, round(avg(engagement_rate), 6) AS mean_rate,
  round(stddev_samp(engagement_rate), 6) AS sd_rate, count(view_count) AS n_pairs, CASE WHEN var_pop(length(title)) * var_pop(view_count) > 0 THEN round(corr(length(title), view_count), 6) END AS r_title_views
FROM w GROUP BY niche, ano, length_class"""),
        "overview_totals": _over("""
SELECT niche, length_class, count(*) AS n_videos, cast(sum(view_count) AS BIGINT) AS total_views,
  replace(format('{:,}', cast(sum(view_count) AS BIGINT)), ',', '.') AS total_views_text
FROM w WHERE length_class IS NOT NULL GROUP BY ALL"""),
        "overview_monthly": _over("""
SELECT niche, length_class, ano_mes_publish, count(*) AS n_videos, cast(sum(view_count) AS BIGINT) AS total_views
FROM w WHERE length_class IS NOT NULL GROUP BY ALL"""),
        "channel_list": _over("SELECT DISTINCT niche, channel_name FROM w"),
        "channel_month_compare": _over(f"""
SELECT niche, length_class, mes, channel_name, {_year_columns()}, monthname(make_date(2000, mes, 1)) AS month_name
FROM w WHERE ano IN {YEARS} AND length_class IS NOT NULL GROUP BY niche, length_class, mes, channel_name"""),
        "channel_year_join": _over(f"""
SELECT niche, channel_name, {_year_columns()} FROM w WHERE ano IN {YEARS} GROUP BY niche, channel_name"""),
        "records": _records(),
        "weekday_stats": _over(
            """SELECT * REPLACE (round(media_views, 6) AS media_views,
  round(media_engagement, 6) AS media_engagement) FROM wd""",
            _DAY_STATS,
        ),
        "weekday_popularity": _over(
            """SELECT niche, first(day_of_week ORDER BY count_videos DESC, day_number) AS most_popular_day,
  max(count_videos) AS most_popular_videos,
  first(day_of_week ORDER BY count_videos, day_number) AS least_popular_day,
  min(count_videos) AS least_popular_videos FROM wd GROUP BY niche""",
            _DAY_STATS,
        ),
        "weekday_best_worst": _over(
            """SELECT niche, best_day_pt, round(best_media_views, 6) AS best_media_views, worst_day_pt,
  round(worst_media_views, 6) AS worst_media_views,
  round((best_media_views - worst_media_views) / worst_media_views * 100, 6) AS diff_pct FROM bd""",
            _DAY_STATS,
            _BEST_DAY,
        ),
        "weekday_anova": _anova(),
        "monthly_seasonality": _over(
            """SELECT niche, ano, mes, date, num_videos, round(media_views, 6) AS media_views, total_views,
  round(media_engagement, 6) AS media_engagement, round(media_likes, 6) AS media_likes FROM mo""",
            _MONTHS,
        ),
        "monthly_trend": _trend(),
        "long_short_stats": _over("""
SELECT niche, length_class, count(*) AS count, round(avg(view_count), 6) AS avg_views,
  round(avg(like_count), 6) AS avg_likes, round(avg(comment_count), 6) AS avg_comments,
  round(avg(engagement_rate), 6) AS avg_engagement, max(view_count) AS max_views,
  round(max(engagement_rate), 6) AS max_engagement
FROM w WHERE length_class IS NOT NULL GROUP BY ALL"""),
        "long_short_compare": _over(" UNION ALL ".join(
            f"""SELECT niche, '{metric}' AS metric,
  round(avg({column}) FILTER (length_class = 'long'), 6) AS long,
  round(avg({column}) FILTER (length_class = 'short'), 6) AS short FROM w GROUP BY niche"""
            for metric, column in {
                "avg_views": "view_count",
                "avg_likes": "like_count",
                "avg_comments": "comment_count",
                "avg_engagement": "engagement_rate",
            }.items()
        )),
        "long_short_ratio": _over(f"SELECT niche, {_RATIO_COLUMNS} FROM ra", _RATIO),
        "welch_long_short": _welch_long_short(),
        "views_box": _over(
            """SELECT niche, length_class, min, q1, median, q3, max,
  min(view_count) FILTER (inside) AS lower_fence, max(view_count) FILTER (inside) AS upper_fence,
  count(*) FILTER (NOT inside) AS n_outliers FROM mk GROUP BY ALL""",
            _box("view_count"),
        ),
        "log_views_box": _over(
            """SELECT niche, length_class, round(min, 6) AS min, round(q1, 6) AS q1, round(median, 6) AS median,
  round(q3, 6) AS q3, round(max, 6) AS max, round(min(value) FILTER (inside), 6) AS lower_fence,
  round(max(value) FILTER (inside), 6) AS upper_fence, count(*) FILTER (NOT inside) AS n_outliers FROM mk GROUP BY ALL""",
            _box("value").replace("FROM w ", "FROM (SELECT *, log10(greatest(view_count, 1)) AS value FROM w) w "),
        ),
        "views_outliers": _over(
            "SELECT niche, length_class, video_id, view_count FROM mk WHERE NOT inside",
            _box("view_count"),
        ),
        "rate_outliers": _over(
            """SELECT niche, length_class, video_id, round(engagement_rate, 6) AS engagement_rate FROM mk
WHERE NOT inside""",
            _box("engagement_rate"),
        ),
        "views_density": _density(),
        "title_length_mean": _over(
            "SELECT niche, round(avg(length(title)), 6) AS avg_title_length FROM w GROUP BY niche"
        ),
        "title_length_perf": _over(
            """SELECT niche, bin_no, label, round(avg_views, 6) AS avg_views, round(avg_likes, 6) AS avg_likes,
  round(avg_engagement, 6) AS avg_engagement, count FROM perf""",
            _BIN_STATS,
        ),
        "drifted_scan": _over("""
SELECT video_id, CASE WHEN ano <> 1997 THEN view_count END AS view_count,
  CASE WHEN ano NOT BETWEEN 1994 AND 1995 THEN like_count END AS like_count FROM s"""),
        "quantiles_by_span": _over("""
SELECT niche, span, probability, count(*) AS n, round(quantile_cont(view_count, probability), 6) AS quantile FROM (
  SELECT niche, view_count, span, unnest([0.1, 0.5, 0.75, 0.99]::DOUBLE[]) AS probability
  FROM w JOIN (VALUES ('1995', '1995-01', '1995-12'), ('winter', '1996-11', '1997-02'), ('all', '1900-01', '2100-12'))
    AS t(span, a, b) ON ano_mes_publish BETWEEN a AND b)
GROUP BY niche, span, probability""").replace("quantile_cont(view_count, probability)", """CASE probability
    WHEN 0.1 THEN quantile_cont(view_count, 0.1) WHEN 0.5 THEN quantile_cont(view_count, 0.5)
    WHEN 0.75 THEN quantile_cont(view_count, 0.75) ELSE quantile_cont(view_count, 0.99) END"""),
        "shared_channels": _over("""
SELECT a.niche AS first, b.niche AS second, cast(count(*) FILTER (c.channel_id IN a.ids AND c.channel_id IN b.ids) AS BIGINT) AS in_both,
  cast(count(*) FILTER (c.channel_id IN a.ids OR c.channel_id IN b.ids) AS BIGINT) AS in_either,
  cast(count(*) FILTER (c.channel_id IN a.ids AND c.channel_id NOT IN b.ids) AS BIGINT) AS only_first,
  cast(count(*) FILTER (c.channel_id IN b.ids AND c.channel_id NOT IN a.ids) AS BIGINT) AS only_second
FROM g a JOIN g b ON a.niche < b.niche CROSS JOIN (SELECT DISTINCT channel_id FROM v) c
GROUP BY a.niche, b.niche""", """
g AS (
  SELECT niche, list(DISTINCT channel_id) AS ids FROM (
    SELECT niche, channel_id FROM v UNION ALL SELECT 'ASIA', channel_id FROM v WHERE channel_id LIKE '%7') GROUP BY niche
)"""),
        "title_length_display": _over(
            """SELECT niche, bin_no, label, round_even(avg_views, 0) AS avg_views, round_even(avg_likes, 2) AS avg_likes,
  round_even(avg_engagement, 2) AS avg_engagement, count FROM perf""",
            _BIN_STATS,
        ),
        "guards": _over("""
SELECT guard, outcome, n FROM (VALUES ('written', 'done'), ('empty frame', 'not written'),
  ('unknown format', 'no sink for ' || chr(39) || 'xlsx' || chr(39)),
  ('missing columns', 'columns missing: published_at, duration, like_count, comment_count'),
  ('no path', 'path must be a non-empty string')) AS g(guard, outcome), (SELECT count(*) AS n FROM v)"""),
        "title_length_best": _over(
            """SELECT niche, best_views_length, round(best_avg_views, 6) AS best_avg_views,
  best_engagement_length, round(best_avg_engagement, 6) AS best_avg_engagement FROM lb""",
            _BIN_STATS,
            _LENGTH_BEST,
        ),
        "title_length_corr": _length_correlation(),
        "top_words": _over(
            f"SELECT niche, word, n, rank FROM ranked WHERE rank <= {fixed.TOP_WORDS}", _WORDS
        ),
        "word_weights": _over(
            """SELECT niche, word, n, round(n / max(n) OVER (PARTITION BY niche), 6) AS weight FROM counts""",
            _WORDS,
        ),
        "keyword_impact": _over(
            """SELECT niche, rank, keyword, na AS videos_with, nb AS videos_without,
  round(ma, 6) AS avg_views_with, round(mb, 6) AS avg_views_without,
  round(la, 6) AS avg_likes_with, round(lb, 6) AS avg_likes_without,
  round(ea, 6) AS avg_engagement_with, round(eb, 6) AS avg_engagement_without,
  round(t_stat, 6) AS t_stat, round(df, 6) AS df, round(p_value, 6) AS p_value, significant FROM kw_p""",
            _WORDS,
            _KEYWORD,
        ),
        "keyword_many": _over(
            """SELECT niche, rank, keyword, na AS videos_with, nb AS videos_without,
  round(ma, 6) AS avg_views_with, round(mb, 6) AS avg_views_without,
  round(la, 6) AS avg_likes_with, round(lb, 6) AS avg_likes_without,
  round(ea, 6) AS avg_engagement_with, round(eb, 6) AS avg_engagement_without,
  round(t_stat, 6) AS t_stat, round(df, 6) AS df, round(p_value, 6) AS p_value, significant FROM kw_p WHERE na > 0""",
            _WORDS.replace("ranked AS (", "ranked_by_niche AS ("),
            """
ranked AS (
  SELECT niche, word, cast(rank AS INTEGER) AS rank FROM (
    SELECT word, row_number() OVER (ORDER BY sum(n) DESC, word) AS rank FROM counts GROUP BY word),
    (SELECT DISTINCT niche FROM w)
)""",
            _KEYWORD.replace(f"rank <= {fixed.TOP_WORDS}", "rank <= 1000"),
        ),
        "emoji_impact": _over(
            " UNION ALL ".join(
                f"""SELECT niche, '{fixed.EMOJI_LABELS[side == "a"]}' AS has_emoji,
  round(m{side}, 6) AS avg_views, round(l{side}, 6) AS avg_likes, round(e{side}, 6) AS avg_engagement,
  n{side} AS count, round(emoji_percentage, 6) AS emoji_percentage, round(t_stat, 6) AS t_stat,
  round(df, 6) AS df, round(p_value, 6) AS p_value, significant FROM em_p WHERE n{side} > 0"""
                for side in ("a", "b")
            ),
            _EMOJI_STATS,
        ),
        "duration_corr": _over("""
SELECT niche, n, round(r, 6) AS r,
  CASE WHEN r > 0.3 THEN 'positiva' WHEN r < -0.3 THEN 'negativa' ELSE 'pouca' END AS correlation
FROM (SELECT niche, count(*) AS n, corr(view_count, duration) AS r FROM w
      WHERE length_class = 'long' GROUP BY niche)"""),
        "view_quantiles": _over("""
SELECT niche, round(quantile_cont(view_count, 0.75), 6) AS popular_views,
  round(quantile_cont(view_count, 0.99) FILTER (length_class = 'long'), 6) AS long_views_limit,
  round(quantile_cont(duration / 60, 0.99) FILTER (length_class = 'long'), 6) AS long_minutes_limit
FROM w GROUP BY niche"""),
        "duration_scatter": _over(
            """SELECT niche, video_id, title, channel_name, round(duration_minutes, 6) AS duration_minutes,
  view_count FROM sc""",
            _SCATTER,
        ),
        "duration_fit": _over(
            """SELECT niche, round(slope, 6) AS slope, round(intercept, 6) AS intercept, point,
  round(x0 + point * (x1 - x0) / 99, 6) AS x,
  round(intercept + slope * (x0 + point * (x1 - x0) / 99), 6) AS y
FROM (SELECT niche, regr_slope(view_count, duration_minutes) AS slope,
        regr_intercept(view_count, duration_minutes) AS intercept,
        min(duration_minutes) AS x0, max(duration_minutes) AS x1,
        unnest(list_transform(range(100), lambda i: cast(i AS INTEGER))) AS point
      FROM sc GROUP BY niche)""",
            _SCATTER,
        ),
        "recommendations": _over(
            f"""SELECT niche, {_RATIO_COLUMNS}, best_views_length, keyword,
  coalesce(kw_p.significant, false) AS use_keyword, coalesce(em_p.significant, false) AS use_emoji,
  best_day_pt AS publish_on
FROM ra JOIN lb USING (niche) JOIN kw_p USING (niche) JOIN em_p USING (niche) JOIN bd USING (niche)
WHERE kw_p.rank = 1""",
            _BIN_STATS,
            _LENGTH_BEST,
            _WORDS,
            _KEYWORD,
            _EMOJI_STATS,
            _DAY_STATS,
            _BEST_DAY,
            _RATIO,
        ),
        "stream_daily": """
SELECT cast(ts AS DATE) AS day, count(*) AS n, round(sum(value), 6) AS total FROM events GROUP BY ALL""",
    }
    return found | {"json_scan_channels": found["bronze_channels"]}
