"""SQL for the operators of this subpackage that SQL can express."""

from __future__ import annotations

from . import audit, pii, resample


# The runs that secrets and social security numbers are a whole of, the form that they need, and what a text with one has.
WIDE = {"secret": r"[A-Za-z0-9]+", "ssn": r"[0-9-]+"}
FORMS = {"secret": "^[A-Fa-f0-9]{32,64}$", "ssn": "^[0-9]{3}-[0-9]{2}-[0-9]{4}$"}
MAY = {"secret": "[A-Fa-f0-9]{32}", "ssn": "[0-9]{3}-[0-9]{2}-[0-9]{4}"}


def _plain(pattern: str) -> str:
    """A pattern without possessive marks and look-arounds, which find the same matches only faster."""
    for long in (r"(?:(?<![A-Za-z0-9._%+-])|\G)", r"(?:(?<![0-9])|\G)"):
        pattern = pattern.replace(long, "")
    return pattern.replace("++", "+")


def _found(kind: str) -> str:
    """Start, end and body of the confirmed matches of a kind in t, with what is around them."""
    p = WIDE.get(kind) or _plain(pii.PATTERNS[kind])
    chars = lambda what: f"coalesce(list_sum(list_transform({what}, lambda x: length(x))), 0)"
    made = f"list_transform(range(1, len(mm) + 1), lambda i: {{'s': CAST({chars('pp[1:i]')} + {chars('mm[1:i - 1]')} AS BIGINT), 'b': mm[i]}})"
    digits = "regexp_replace(m.b, '[^0-9]', '', 'g')"
    luhn = (
        f"list_sum(list_transform(range(1, length({digits}) + 1), lambda i: CASE WHEN i % 2 = 1 THEN CAST({digits}[-i] AS INTEGER) WHEN {digits}[-i] > '4' THEN 2 * CAST({digits}[-i] AS INTEGER) - 9 "
        f"ELSE 2 * CAST({digits}[-i] AS INTEGER) END)) % 10 = 0"
    )
    bare = "replace(m.b, ' ', '')"
    turned = f"(substr({bare}, 5) || substr({bare}, 1, 4))"
    number = f"list_reduce(list_prepend(CAST(0 AS BIGINT), list_transform(string_split({turned}, ''), lambda c: CAST(ascii(c) - CASE WHEN c >= 'A' THEN 55 ELSE 48 END AS BIGINT))), lambda a, d: (a * CASE WHEN d > 9 THEN 100 ELSE 10 END + d) % 97) = 1"
    apart = f"NOT regexp_matches(CASE WHEN m.s > 0 THEN substr(t, m.s, 1) ELSE '' END, '{pii.APART.get(kind, '')}') AND NOT regexp_matches(substr(t, m.s + length(m.b) + 1, 1), '{pii.APART.get(kind, '')}')"
    valid = {
        "email": "true", "ip": "len(list_filter(string_split(m.b, '.'), lambda x: length(ltrim(x, '0')) > 3 OR lpad(ltrim(x, '0'), 3, '0') > '255')) = 0", "card": f"length({digits}) BETWEEN 16 AND 19 AND {luhn}",
        "phone": f"length({digits}) BETWEEN 8 AND 15", "iban": f"{apart} AND {number}", "short_card": f"length({digits}) BETWEEN 13 AND 15 AND {luhn}",
        "secret": f"regexp_matches(m.b, '{FORMS['secret']}')", "ssn": f"regexp_matches(m.b, '{FORMS['ssn']}') AND m.b[1:3] NOT IN ('000', '666') AND m.b[1] <> '9'", "local_phone": apart,
    }[kind]
    near = f"lower(substr(t, greatest(m.s - {pii.NEAR}, 0) + 1, m.s - greatest(m.s - {pii.NEAR}, 0)) || ' ' || substr(t, m.s + length(m.b) + 1, {pii.NEAR}))"
    told = " OR ".join(f"contains({near}, '{w}')" for w in pii.CONTEXT[kind])
    limit = f"AND score >= {pii.THRESHOLD}" if kind in pii.ADDED else ""
    order = (*pii.BASE, *pii.ADDED).index(kind)
    return f"""SELECT doc_id, {order} AS ord, '{kind}' AS kind, s, e, score FROM (
        SELECT doc_id, m.s AS s, m.s + length(m.b) AS e, round(least({pii.SCORES[kind]} + CASE WHEN {told} THEN {pii.CONTEXT_SCORE} ELSE 0.0 END, 1.0), 2) AS score
        FROM (SELECT doc_id, t, unnest({made}) AS m FROM (SELECT doc_id, t, string_split_regex(t, '{p}') AS pp, regexp_extract_all(t, '{p}') AS mm FROM d WHERE regexp_matches(t, '{MAY.get(kind) or p}')))
        WHERE {valid}) WHERE true {limit}"""


def personal_data() -> str:
    """op6: all kinds of spans of each text, joined as the query joins them."""
    every = " UNION ALL ".join(_found(k) for k in (*pii.BASE, *pii.ADDED))
    base = len(pii.BASE)
    text = "kind || ':' || s || ':' || e"
    counts = ", ".join(f"coalesce(count(*) FILTER (WHERE kind = '{k}'), 0) AS n_{k}" for k in pii.BASE)
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), a AS ({every}),
        kept AS (SELECT * FROM a WHERE ord < {base} OR NOT EXISTS (SELECT 1 FROM a b WHERE b.doc_id = a.doc_id AND b.ord < {base} AND b.s < a.e AND a.s < b.e))
        SELECT doc_id, {counts}, sha256(coalesce(string_agg({text}, ',' ORDER BY ord, s) FILTER (WHERE ord < {base}), '')) AS base_sha256,
            coalesce(string_agg({text}, ',' ORDER BY ord, s), '') AS spans, coalesce(string_agg(CAST(score AS DOUBLE)::VARCHAR, ',' ORDER BY ord, s), '') AS scores, count(kind) AS n_spans, count(kind) > 0 AS personal
        FROM d LEFT JOIN kept USING (doc_id) GROUP BY doc_id"""


def resampling() -> str:
    """op12: CRC-32 of each distinct word by a fold over its bytes, histograms, gains, noise and the draw."""
    capital = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
    words = lambda text: f"regexp_extract_all(translate(coalesce({text}, ''), {capital}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    b = resample.BUCKETS
    return f"""WITH RECURSIVE step AS (SELECT CAST(i AS BIGINT) AS i, 0 AS k, CAST(i AS BIGINT) AS v FROM range(256) r(i) UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM step WHERE k < 8),
        crc AS (SELECT list(v ORDER BY i) AS t FROM step WHERE k = 8),
        d AS (SELECT doc_id, row_number() OVER () AS n, {words("text")} AS w FROM documents), m AS (SELECT {words("text")} AS w FROM benchmark),
        dw AS (SELECT n, unnest(w) AS w FROM d), mw AS (SELECT unnest(w) AS w FROM m),
        every AS (SELECT DISTINCT w FROM (SELECT w FROM dw UNION ALL SELECT w FROM mw)),
        bytes AS (SELECT w, list_transform(range(1, len(hex(encode(w))), 2), lambda i: CAST('0x' || hex(encode(w))[i:i + 1] AS BIGINT)) AS b FROM every),
        bucket AS (SELECT w, (4294967295 - list_reduce(list_prepend(CAST(4294967295 AS BIGINT), b), lambda a, x: xor(a >> 8, t[1 + (xor(a, x) & 255)]))) % {b} AS b FROM bytes, crc),
        s AS (SELECT b, count(*) AS n FROM dw JOIN bucket USING (w) GROUP BY b), t AS (SELECT b, count(*) AS n FROM mw JOIN bucket USING (w) GROUP BY b),
        whole AS (SELECT (SELECT count(*) FROM dw) AS s, (SELECT count(*) FROM mw) AS t),
        gain AS (SELECT b, CAST(floor({resample.SCALE} * ln((coalesce(t.n, 0) + 1)::DOUBLE * (whole.s + {b})::DOUBLE / ((coalesce(s.n, 0) + 1)::DOUBLE * (whole.t + {b})::DOUBLE))) AS BIGINT) AS g FROM s FULL JOIN t USING (b), whole),
        sums AS (SELECT n, sum(g) AS g FROM dw JOIN bucket USING (w) JOIN gain USING (b) GROUP BY n),
        weighed AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features, CAST(coalesce(floor(g / len(w)), 0) AS BIGINT) AS weight,
            CAST('0x' || sha256('{resample.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), ''))[1:8] AS BIGINT) AS h FROM d LEFT JOIN sums USING (n)),
        scored AS (SELECT doc_id, n_features, weight, weight + CAST(floor(-{resample.SCALE} * ln(-ln((h + 0.5)::DOUBLE / 4294967296))) AS BIGINT) AS score FROM weighed),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY n_features >= {resample.LEAST_WORDS} ORDER BY score DESC, doc_id NULLS LAST) AS r, count(*) OVER (PARTITION BY n_features >= {resample.LEAST_WORDS}) AS n FROM scored)
        SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= {resample.LEAST_WORDS} AND r <= n * {resample.PERCENT} // 100 THEN r END AS rank FROM ranked"""


def filter_audit() -> str:
    """op13: every step of every order counted from the documents' failures, with no use of coalitions or shares."""
    word = r"[^\x20\x09-\x0D]+"
    letters = "(VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS {0}(f, b)"
    return f"""WITH RECURSIVE d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{word}') AS w, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least FROM documents),
        label AS (SELECT doc_id, max(coalesce(quality = 1, false)) AS good, max(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id),
        failed AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, CASE WHEN len(w) < {audit.MIN_WORDS} THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < {audit.LEAST_DISTINCT} * len(w) THEN 2 ELSE 0 END
            + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > {audit.MOST_CAPITALS} * length(t) THEN 4 ELSE 0 END + CASE WHEN regexp_matches(t, '{audit.SYMBOLS}') THEN 8 ELSE 0 END
            + CASE WHEN coalesce(doc_id > least, least IS NOT NULL) THEN 16 ELSE 0 END AS mask FROM d LEFT JOIN label USING (doc_id)),
        m AS (SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE good) AS g, count(*) FILTER (WHERE toxic) AS x FROM failed GROUP BY part, mask),
        o AS (SELECT f AS filter_order, f, b AS own, 0 AS gone, 1 AS step FROM {letters.replace("{0}", "l")} UNION ALL SELECT o.filter_order || l.f, l.f, l.b, o.gone + o.own, step + 1 FROM o JOIN {letters.replace("{0}", "l")} ON (o.gone + o.own) & l.b = 0),
        steps AS (SELECT whole.filter_order, o.f, o.own, o.gone, o.step FROM o JOIN (SELECT filter_order FROM o WHERE step = 5) whole ON starts_with(whole.filter_order, o.filter_order)),
        counted AS (SELECT part, filter_order, f, step, coalesce(sum(n) FILTER (WHERE mask & (gone + own) = 0), 0) AS kept, coalesce(sum(n) FILTER (WHERE mask & gone = 0 AND mask & own > 0), 0) AS removed,
            coalesce(sum(n) FILTER (WHERE mask & gone > 0 AND mask & own > 0), 0) AS redundant, coalesce(sum(n) FILTER (WHERE mask = own), 0) AS unique_fails,
            coalesce(sum(g) FILTER (WHERE mask & gone = 0 AND mask & own > 0), 0) AS good_lost, coalesce(sum(x) FILTER (WHERE mask & gone = 0 AND mask & own > 0), 0) AS toxic_lost FROM steps, m GROUP BY ALL)
        SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
            CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley FROM counted"""
