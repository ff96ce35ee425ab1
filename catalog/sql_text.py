"""DuckDB expressions for the text functions, written independently of Spark's."""

from __future__ import annotations

from tickerloom.functions import fixed_values as fixed

WS = r"\t-\r\x1C-\x20\x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"


def quoted(values) -> str:
    return ", ".join("'" + value + "'" for value in values)


def sub(expression: str, pattern: str, replacement: str = "", flags: str = "g") -> str:
    return f"regexp_replace({expression}, '{pattern}', '{replacement}', '{flags}')"


def strip(expression: str) -> str:
    return sub(expression, f"^[{WS}]+|[{WS}]+$")


def clean(expression: str) -> str:
    text = f"lower(coalesce({expression}, ''))"
    text = sub(text, f"http[^{WS}]+|www[^{WS}]+|https[^{WS}]+")
    text = sub(text, f"[^{WS}]+@[^{WS}]+")
    text = sub(text, f"[^a-zA-Z{WS}.,!?;:]")
    return strip(sub(text, f"[{WS}]+", " "))


def no_boilerplate(expression: str) -> str:
    for pattern in fixed.BOILERPLATE_PATTERNS:
        expression = sub(expression, pattern.replace(r"\s", f"[{WS}]"), "", "gi")
    return strip(expression)


def tokens(expression: str) -> str:
    for pair in fixed.SPLIT_CONTRACTIONS:
        left, right = pair.split()
        expression = sub(expression, rf"\b{left}{right}\b", f"{left} {right}")
    expression = sub(sub(expression, "[,!?;:]", " "), r"(\.{2,})", r" \1 ")
    pieces = f"string_split_regex({expression}, '[{WS}]+')"
    undotted = (
        f"list_transform({pieces}, lambda w: CASE WHEN regexp_matches(w, '[^.]\\.$') "
        f"THEN left(w, length(w) - 1) ELSE w END)"
    )
    return f"list_filter({undotted}, lambda w: length(w) > 2 AND w NOT IN ({quoted(fixed.ENGLISH_STOP_WORDS)}))"


def preprocess(expression: str) -> str:
    return f"array_to_string({tokens(no_boilerplate(clean(expression)))}, ' ')"


def words(expression: str) -> str:
    return f"list_filter(string_split_regex({expression}, '[{WS}]+'), lambda w: w <> '')"


def hits(expression: str, vocabulary) -> str:
    return f"len(list_filter({words(f'lower(coalesce({expression}, {chr(39)*2}))')}, lambda w: w IN ({quoted(vocabulary)})))"


def ratio(positive: str, negative: str) -> str:
    return f"coalesce(({positive} - {negative}) / nullif({positive} + {negative}, 0), 0.0)"


def trading_date(timestamp: str) -> str:
    local = f"(({timestamp}) AT TIME ZONE 'UTC' AT TIME ZONE 'US/Eastern')"
    day = f"(CAST({local} AS DATE) + CASE WHEN hour({local}) >= 16 THEN 1 ELSE 0 END)"
    return f"CAST({day} + CASE isodow({day}) WHEN 6 THEN 2 WHEN 7 THEN 1 ELSE 0 END AS DATE)"


def cleaned_news() -> str:
    headline = "headline"
    for prefix in fixed.HEADLINE_PREFIXES:
        headline = f"replace({headline}, '{prefix}', '')"
    return f"""SELECT * FROM (
        SELECT doc_id, ticker, {strip(headline)} AS headline, {strip('content')} AS content, timestamp, source, url, lang
        FROM news QUALIFY row_number() OVER (PARTITION BY news.headline, news.content ORDER BY doc_id) = 1)
      WHERE length(headline) > 10 AND length(content) > 20 AND timestamp IS NOT NULL"""


def articles(source: str = "news") -> str:
    return f"""SELECT *, headline_clean || ' ' || content_clean AS combined_text,
        length(headline_clean) AS headline_chars, length(content_clean) AS content_chars,
        length(headline_clean) + length(content_clean) AS total_chars
      FROM (SELECT *, {preprocess('headline')} AS headline_clean, {preprocess('content')} AS content_clean,
                   {trading_date('timestamp')} AS trading_date FROM {source})"""


DAILY_NEWS = f"""SELECT ticker, trading_date, CAST(sum(headline_chars) AS BIGINT) AS total_headline_chars,
    CAST(sum(content_chars) AS BIGINT) AS total_content_chars, CAST(sum(total_chars) AS BIGINT) AS total_chars_sum,
    round_even(avg(total_chars), 2) AS avg_article_length, count(headline) AS article_count
  FROM ({articles()}) GROUP BY ticker, trading_date"""
