"""DuckDB SQL of the queries that SQL can express, by name."""

from __future__ import annotations

from paddock.llm import licensing, spotsigs, warc

UPPER_TO_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def sixty_bits(text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT)"


SOURCE_KEY = "CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END"

SQL = {}

SQL["op1_sharding"] = f"""
WITH step AS (  -- the 256 entries of the table of CRC-32
    SELECT list(list_reduce(list_prepend(b, [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, x:
        CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS t
    FROM (SELECT CAST(range AS BIGINT) AS b FROM range(256))),
hexed AS (
    SELECT doc_id, source, CAST(coalesce(strlen(text), 0) + 1 AS BIGINT) AS size,
           list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda p: CAST('0x' || p AS BIGINT)) AS bytes
    FROM documents),
rows AS (
    SELECT doc_id, source, size, {SOURCE_KEY} AS src,
           xor(list_reduce(list_prepend(4294967295, bytes), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32
    FROM hexed, step),
hashed AS (
    SELECT *, {sixty_bits("'1:' || coalesce(CAST(doc_id AS VARCHAR), '-') || ':' || size || ':' || text_crc32")} AS h,
           CAST({sixty_bits("'1:' || src")} >> 40 AS DOUBLE) / 1048576 AS u
    FROM rows),
in_source AS (
    SELECT *, row_number() OVER (PARTITION BY src ORDER BY h, doc_id, size, text_crc32) - 1 AS r, count(*) OVER (PARTITION BY src) AS n
    FROM hashed),
placed AS (
    SELECT *, row_number() OVER (ORDER BY (CAST(r AS DOUBLE) + u) / n, src, h, doc_id, size, text_crc32) - 1 AS pos, count(*) OVER () AS total
    FROM in_source)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(pos * 8 // total AS INT) AS shard,
       CAST(pos - (pos * 8 // total * total + 7) // 8 AS BIGINT) AS slot, CAST(NULL AS INT) AS grown_shard, source
FROM placed
"""

WORD_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def contaminated_words(documents: str = "documents") -> str:
    """CTEs up to ``verdict`` (doc_id, n_words, n_hit, ...) over a table or CTE."""
    return f"""
items AS (
    SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, regexp_extract_all(translate(text, {UPPER_TO_LOWER}), '{WORD_PATTERN}') AS w
    FROM benchmark),
sized AS (SELECT item, w, least(len(w), 13) AS n FROM items WHERE len(w) > 0),
grams AS (
    SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS gram
    FROM (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM sized)),
texts AS (
    SELECT doc_id, coalesce(regexp_extract_all(translate(text, {UPPER_TO_LOWER}), '{WORD_PATTERN}'), []) AS w FROM {documents}),
places AS (
    SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS gram
    FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM texts), (SELECT DISTINCT n FROM grams)
    WHERE i + n - 1 <= len(w)),
hits AS (SELECT doc_id, i, places.n, item FROM places JOIN grams USING (gram) WHERE places.n = grams.n),
hit_words AS (
    SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM (SELECT DISTINCT doc_id, i, n FROM hits)) GROUP BY doc_id),
hit_items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id),
verdict AS (
    SELECT texts.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM texts LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id))"""


SQL["op2_decontamination"] = f"WITH {contaminated_words()}\nSELECT * FROM verdict"

SQL["op6_mixing"] = rf"""
WITH sizes AS (
    SELECT doc_id, source, {SOURCE_KEY} AS src, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
    FROM documents),
sources AS (SELECT src, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY src),
weighed AS (
    SELECT src, source_size, CAST([5, 2, 1][(row_number() OVER (ORDER BY src = 'n', src) - 1) % 3 + 1] AS DOUBLE) AS weight,
           row_number() OVER (ORDER BY src = 'n', src) AS place
    FROM sources),
limits AS (SELECT *, source_size * CAST(2.0 AS DOUBLE) AS most, source_size * CAST(2.0 AS DOUBLE) / weight AS ratio FROM weighed),
levels AS (
    SELECT *, (sum(source_size) OVER () * CAST(1.5 AS DOUBLE) - coalesce(sum(most) OVER before, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
    FROM limits WINDOW before AS (ORDER BY ratio, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
chosen AS (SELECT arg_min(level, (ratio, place)) AS level FROM levels WHERE level <= ratio),
targets AS (
    SELECT src, source_size, least(most, coalesce(chosen.level * weight, most)) AS target,
           CAST({sixty_bits("'6:' || src")} >> 50 AS DOUBLE) / 1024 AS u
    FROM levels LEFT JOIN chosen ON TRUE),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY src ORDER BY length(CAST(size AS VARCHAR)) * 100 + CAST(substr(CAST(size AS VARCHAR), 1, 2) AS BIGINT), h, size, doc_id) - 1 AS r
    FROM (SELECT *, {sixty_bits("'6:' || coalesce(CAST(doc_id AS VARCHAR), '-') || ':' || size")} AS h FROM sizes)),
rated AS (
    SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM ranked JOIN targets USING (src)),
copied AS (
    SELECT *, CAST(least(floor((r + 1) * rate + u) - floor(r * rate + u), ceil(rate)) AS INT) AS copies FROM rated)
SELECT doc_id, size, source_size, target, CAST(size * copies AS BIGINT) AS taken, source, copies FROM copied
"""


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


# The law of the SQL: a line goes on in one that begins with a small letter, and a
# sentence ends at '.', '!', '?' or ';' before a blank.
WRAPPED_LINE = r"\r?\n[ \t]*(?:[#*/;]+[ \t]*)?([a-z(])"
ENDED_SENTENCE = r"([.!?;])[ \t\r\n]+"
SENTENCE_NOISE = r"[^a-z0-9.\n-]+"
SENTENCE_EDGES = r"^[ .-]+|[ .-]+$"


def license_sql() -> str:
    known = ", ".join(f"{text(k)}: {text(v)}" for k, v in licensing.SENTENCES.items())
    steps, found = [], []
    for i, (license_id, sequence) in enumerate(licensing.RULES):
        needle = text("".join(f"<{name}>" for name in sequence.split()))
        steps.append(f"replace(left{i}, {needle}, '|') AS left{i + 1}")
        found.append(f"CASE WHEN contains(left{i}, {needle}) THEN {text(license_id)} END")
    end = f"left{len(licensing.RULES)}"
    return f"""
WITH cut AS (
    SELECT doc_id, text, regexp_replace(regexp_replace(text, {text(WRAPPED_LINE)}, ' \\1', 'g'), {text(ENDED_SENTENCE)}, '\\1' || chr(10), 'g') AS t
    FROM documents),
cues AS (
    SELECT doc_id, CASE WHEN regexp_matches(text, '(?i){licensing.CUE}') THEN list_filter(
        string_split(regexp_replace(translate(t, {UPPER_TO_LOWER}), {text(SENTENCE_NOISE)}, ' ', 'g'), chr(10)),
        lambda s: regexp_matches(s, '{licensing.CUE}') AND NOT regexp_matches(s, '^[ .-]*copyright')) ELSE [] END AS cues
    FROM cut),
named AS (
    SELECT doc_id, list_transform(cues, lambda s: coalesce(MAP {{{known}}}[regexp_replace(s, {text(SENTENCE_EDGES)}, '', 'g')], '?')) AS ids FROM cues),
used AS (
    SELECT doc_id, ids, array_to_string(list_transform(ids, lambda x: '<' || x || '>'), '') AS left0, {", ".join(steps)} FROM named),
ruled AS (
    SELECT doc_id, array_to_string(ids, ' ') AS sentence_ids, len(regexp_extract_all({end}, '<')) AS n_unknown,
           list_filter([{", ".join(found)}], lambda x: x IS NOT NULL) AS names
    FROM used),
listed AS (
    SELECT *, array_to_string(list_filter(names, lambda x, i: list_position(names, x) = i), ',') AS licenses FROM ruled)
SELECT doc_id, licenses, sentence_ids, CAST(n_unknown AS BIGINT) AS n_unknown,
       CASE WHEN licenses <> '' THEN 'licensed' WHEN n_unknown > 0 THEN 'unknown' ELSE 'none' END AS status
FROM listed"""


SQL["op4_license_scan"] = license_sql()

CHAT_CLEAN = "replace({}, '<|', '< |')"


def opening(t: str) -> str:
    return f"'<|' || {CHAT_CLEAN.format(t + '.role')} || '|>' || chr(10)"


def turn_texts(turns: str) -> str:
    return f"list_transform({turns}, lambda t: {opening('t')} || {CHAT_CLEAN.format('t.text')} || '<|end|>' || chr(10))"


def chat_mask(turns: str) -> str:
    before = f"length(array_to_string({turn_texts(turns)}[1:i - 1], ''))"
    start = f"{before} + length({opening('t')})"
    return f"""array_to_string(list_filter(list_transform({turns}, lambda t, i: CASE WHEN t.role = 'assistant' THEN
        ({start}) || '-' || ({start} + length({CHAT_CLEAN.format('t.text')}) + 7) END), lambda x: x IS NOT NULL), ' ')"""


SQL["op8_chat_format"] = f"""
WITH grouped AS (
    SELECT conv_id, list(struct_pack(turn := turn, role := coalesce(role, 'user'), text := coalesce(text, '')) ORDER BY turn, role, text) AS turns
    FROM conversations GROUP BY conv_id),
ended AS (
    SELECT *, list_max(list_transform(turns, lambda t, i: CASE WHEN t.role = 'assistant' THEN i ELSE 0 END)) AS n FROM grouped),
paired AS (
    SELECT a.conv_id, a.turns AS chosen,
           CASE WHEN a.n > 0 THEN list_concat(list_concat(a.turns[1:a.n - 1], [struct_pack(turn := a.turns[a.n].turn, role := a.turns[a.n].role,
               text := CASE WHEN b.n > 0 THEN b.turns[b.n].text ELSE '' END)]), a.turns[a.n + 1:]) ELSE a.turns END AS rejected
    FROM ended a LEFT JOIN ended b ON b.conv_id = xor(a.conv_id, 1)),
same AS (
    SELECT *, list_position(list_transform(chosen, lambda t, i: i <= len(rejected) AND t.role = rejected[i].role AND t.text = rejected[i].text), false) AS first
    FROM paired),
cut AS (SELECT *, CAST(coalesce(first - 1, len(chosen)) AS BIGINT) AS n FROM same),
rest AS (SELECT *, chosen[n + 1:] AS c, rejected[n + 1:] AS r FROM cut)
SELECT conv_id, n AS n_prompt_turns, array_to_string({turn_texts('chosen[1:n]')}, '') AS prompt,
       array_to_string({turn_texts('c')}, '') AS chosen_text, array_to_string({turn_texts('r')}, '') AS rejected_text,
       {chat_mask('c')} AS chosen_mask, {chat_mask('r')} AS rejected_mask, len(c) > 0 OR len(r) > 0 AS differs
FROM rest
"""

ANCHOR_LIST = ", ".join(text(w) for w in spotsigs.ANCHORS)

SQL["op9_spotsigs"] = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n FROM documents),
following AS (
    SELECT doc_id, t, n, coalesce(lead(t) OVER w, first_value(t) OVER w) AS next
    FROM docs WINDOW w AS (ORDER BY doc_id DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
changed AS (SELECT doc_id, n, t, next, substr(t, 1, n - n // 2) || substr(next, 1, n // 2) AS edited FROM following),
texts AS (
    SELECT doc_id, 't' AS kind, t FROM changed UNION ALL SELECT doc_id, 'e', edited FROM changed UNION ALL SELECT doc_id, 'n', next FROM changed),
cut AS (SELECT doc_id, kind, regexp_extract_all(lower(t), '{spotsigs.WORD}') AS w FROM texts),
parted AS (
    SELECT *, list_filter(w, lambda x: x NOT IN ({ANCHOR_LIST})) AS content,
           list_filter(list_transform(w, lambda x, i: CASE WHEN x IN ({ANCHOR_LIST}) THEN i END), lambda i: i IS NOT NULL) AS places
    FROM cut),
chained AS (
    SELECT *, list_filter(list_transform(places, lambda p, j: CASE WHEN p - j + 2 <= len(content) THEN
        substr(md5(w[p] || ' ' || content[p - j + 1] || ' ' || content[p - j + 2]), 1, 8) END), lambda x: x IS NOT NULL) AS sigs
    FROM parted),
sets AS (
    SELECT doc_id, kind, CASE WHEN len(sigs) > 0 THEN list_sort(list_distinct(sigs)) ELSE [substr(md5(array_to_string(w, ' ')), 1, 8)] END AS s
    FROM chained),
joined AS (
    SELECT c.doc_id, c.n, c.edited, a.s AS s, b.s AS e, len(list_intersect(a.s, b.s)) AS ie, len(list_intersect(a.s, d.s)) AS ix, d.s AS x
    FROM changed c JOIN sets a ON a.doc_id = c.doc_id AND a.kind = 't' JOIN sets b ON b.doc_id = c.doc_id AND b.kind = 'e'
    JOIN sets d ON d.doc_id = c.doc_id AND d.kind = 'n')
SELECT doc_id, CAST(n AS BIGINT) AS n_chars, sha256(edited) AS edited_sha256, array_to_string(s, '') AS fingerprint,
       array_to_string(e, '') AS edited_fingerprint, CAST(ie AS DOUBLE) / (len(s) + len(e) - ie) AS near_edited,
       CAST(ix AS DOUBLE) / (len(s) + len(x) - ix) AS near_next
FROM joined
"""


# The references that the given pages hold, and the five of XML and the space.
PAGE_REFERENCES = [("&copy;", "©"), ("&middot;", "·"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&nbsp;", "\u00a0")]


def unescaped(value: str) -> str:
    for entity, char in PAGE_REFERENCES:
        value = f"replace({value}, {text(entity)}, {text(char)})"
    return f"replace({value}, '&amp;', '&')"


def replaced(value: str, steps: list) -> str:
    for pattern, new in steps:
        value = f"regexp_replace({value}, {text(pattern)}, {'chr(10)' if new == chr(10) else text(new)}, 'g')"
    return value


def urn(*parts: str) -> str:
    h = f"md5({' || chr(10) || '.join(parts)})"
    return "'<urn:uuid:' || " + " || '-' || ".join(f"substr({h}, {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))) + " || '>'"


END = "chr(13) || chr(10)"
SCHEME = "[a-zA-Z][a-zA-Z0-9+.-]*"

# Numbered entities, which the given pages don't have, are left as they are here.
SQL["op10_warc"] = f"""
WITH pages_in AS (
    SELECT page_id, regexp_replace(coalesce(url, ''), '[\r\n]+', ' ', 'g') AS uri, coalesce(html, '') AS html FROM pages),
responses AS (
    SELECT *, {urn("'response'", "coalesce(CAST(page_id AS VARCHAR), '-')", "uri", "sha256(html)")} AS refers_to, 'sha256:' || sha256(html) AS source_digest FROM pages_in),
linked AS (
    SELECT *, list_transform(regexp_extract_all(html, {text(warc.LINK)}, 1), lambda x: regexp_replace(trim(replace(x, '&amp;', '&')), '#.*$', '')) AS hrefs,
           regexp_extract(uri, '^{SCHEME}://[^/?#]*') AS root, regexp_extract(uri, '^{SCHEME}://[^/?#]*(?:/[^?#]*/|/)?') AS folder
    FROM responses),
resolved AS (
    SELECT *, list_filter(list_transform(hrefs, lambda x: CASE WHEN x = '' THEN NULL WHEN regexp_matches(x, '^(?i:javascript|mailto|data|tel):') THEN NULL
        WHEN regexp_matches(x, '^{SCHEME}://') THEN x WHEN starts_with(x, '//') THEN regexp_extract(uri, '^{SCHEME}:') || x
        WHEN starts_with(x, '/') THEN root || x ELSE (CASE WHEN ends_with(folder, '/') THEN folder ELSE folder || '/' END) || x END), lambda x: x IS NOT NULL) AS links,
        regexp_replace({replaced(unescaped(f"regexp_extract(html, {text(warc.TITLE)}, 1)"), warc.TIDY)}, '[\r\n]+', ' ', 'g') AS title,
        {replaced(unescaped(replaced("html", warc.STRIP)), warc.TIDY)} AS plain
    FROM linked),
blocks AS (
    SELECT page_id, refers_to, uri, source_digest, 'metadata' AS warc_type, 'application/warc-fields' AS content_type,
        'source-payload-digest: ' || source_digest || {END} || 'source-payload-length: ' || strlen(html) || {END}
        || CASE WHEN title = '' THEN '' ELSE 'title: ' || title || {END} END
        || 'source-http: HTTP/1.1 200 OK' || {END} || 'source-http: Content-Type: text/html; charset=utf-8' || {END}
        || 'source-http: Content-Length: ' || strlen(html) || {END}
        || array_to_string(list_transform(list_filter(links, lambda x, i: list_position(links, x) = i), lambda x: 'outlink: ' || x || ' L a/@href' || {END}), '') AS block
    FROM resolved
    UNION ALL SELECT page_id, refers_to, uri, source_digest, 'conversion', 'text/plain', plain FROM resolved),
digested AS (SELECT *, 'sha256:' || sha256(block) AS block_digest FROM blocks),
named AS (SELECT *, {urn("warc_type", "refers_to", "block_digest")} AS record_id FROM digested)
SELECT page_id, refers_to, uri AS target_uri, '{warc.DATE}' AS date, warc_type, content_type, block, block_digest,
       CAST(strlen(block) AS BIGINT) AS content_length, record_id, source_digest,
       'WARC/1.1' || {END} || 'WARC-Type: ' || warc_type || {END} || 'WARC-Record-ID: ' || record_id || {END} || 'WARC-Refers-To: ' || refers_to || {END}
       || CASE WHEN uri = '' THEN '' ELSE 'WARC-Target-URI: ' || uri || {END} END || 'WARC-Date: {warc.DATE}' || {END}
       || 'WARC-Block-Digest: ' || block_digest || {END} || 'Content-Type: ' || content_type || {END} || 'Content-Length: ' || strlen(block) AS header
FROM named
"""

# The 256 entries of the table of CRC-32, and the CRC of a text by it.
CRC_STEP = """step AS (
    SELECT list(list_reduce(list_prepend(b, [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, x:
        CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS t
    FROM (SELECT CAST(range AS BIGINT) AS b FROM range(256)))"""


def crc32(value: str) -> str:
    codes = f"list_transform(regexp_extract_all(hex(encode({value})), '..'), lambda p: CAST('0x' || p AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295, {codes}), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"


def best(*ways: str) -> str:
    return f"list_min([{', '.join(ways)}])"


def moved(state: str, cost: str, edit: str, line: str = None) -> str:
    """A way to go on from a state: cost, edits and lines so far."""
    lines = f"{state}.o || chr(10) || {line}" if line else f"{state}.o"
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{edit}', 'o': {lines}}}"


def with_inserts(source: str, keep: str) -> str:
    """States after turns may have been put in: one, and then a second."""
    user, assistant = "'user:'", "'assistant:'"
    once = f"""SELECT {keep}, s0, s1, {best("s2", moved("s0", "3", "I", user), moved("s1", "3", "I", user), moved("s3", "3", "I", user))} AS s2,
        {best("s3", moved("s2", "3", "I", assistant))} AS s3 FROM {source}"""
    return f"""SELECT {keep}, s0, s1, {best("s2", moved("s3", "3", "I", user))} AS s2, {best("s3", moved("s2", "3", "I", assistant))} AS s3 FROM ({once})"""


def after_row() -> str:
    """States after the next row: deleted, kept where its role fits, or renamed."""
    user, assistant = "'user:' || f.text", "'assistant:' || f.text"
    extra = "(CASE WHEN f.fault = 't' THEN 3 ELSE 0 END)"
    away = "1000000"

    def gone(s):
        return moved(f"d.{s}", "4", "D")

    def kept(s, initial):
        fits = f"(CASE WHEN f.fault IN ('b', 'd') OR f.initial <> '{initial}' THEN {away} ELSE {extra} END)"
        return moved(f"d.{s}", fits, "K", "f.role || ':' || f.text")

    def renamed(s, line):
        return moved(f"d.{s}", f"(CASE WHEN f.fault IN ('b', 'd') THEN {away} ELSE 3 + {extra} END)", "R", line)

    into_user = [w for s in ("s0", "s1", "s3") for w in (kept(s, "u"), renamed(s, user))]
    return f"""{gone("s0")} AS s0, {best(gone("s1"), kept("s0", "s"))} AS s1, {best(gone("s2"), *into_user)} AS s2,
        {best(gone("s3"), kept("s2", "a"), renamed("s2", assistant))} AS s3"""


EMPTY, NEVER = "{'c': 0, 'a': '', 'o': ''}", "{'c': 1000000, 'a': '', 'o': ''}"

SQL["op11_structure_repair"] = rf"""
WITH RECURSIVE {CRC_STEP},
marked AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           {crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS k
    FROM conversations, step),
harmed AS (
    SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
           CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM (SELECT *, unnest(range(CASE k WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM marked)),
ordered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS seen
    FROM (SELECT *, substr(role, 1, 1) AS initial, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i FROM harmed)),
faulted AS (
    SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair,
           CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'b' WHEN seen > 1 THEN 'd'
                WHEN NOT regexp_matches(text, '[.!?][ 	-
]*$') THEN 't' ELSE 'o' END AS fault
    FROM ordered),
counted AS (
    SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
           count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
           count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM faulted GROUP BY conv_id),
ids AS (SELECT DISTINCT conv_id FROM conversations),
edited AS (
    SELECT * FROM ({with_inserts(f"(SELECT conv_id, CAST(0 AS BIGINT) AS i, {EMPTY} AS s0, {NEVER} AS s1, {NEVER} AS s2, {NEVER} AS s3 FROM ids)", "conv_id, i")})
    UNION ALL
    SELECT * FROM ({with_inserts(f"(SELECT d.conv_id, f.i, {after_row()} FROM edited d JOIN faulted f ON f.conv_id IS NOT DISTINCT FROM d.conv_id AND f.i = d.i + 1)", "conv_id, i")})),
ended AS (SELECT conv_id, i AS n, {best("s0", "s3")} AS s FROM edited)
SELECT e.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(s.c AS BIGINT) AS cost, s.a AS audit,
       sha256(substr(s.o, 2)) AS repaired_sha256
FROM ended e LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
WHERE e.n = coalesce(c.n, 0)
"""

SQL["op13_prefix_trie"] = f"""
WITH {CRC_STEP},
listed AS (
    SELECT conv_id, list(md5(strlen(r) || ':' || r || x) ORDER BY turn NULLS FIRST, r, md5(x)) AS own,
           list(strlen(x) ORDER BY turn NULLS FIRST, r, md5(x)) AS b
    FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations) GROUP BY conv_id),
borrowing AS (
    SELECT *, coalesce({crc32("CAST(conv_id AS VARCHAR)")} % 9, 0) AS h FROM listed, step),
rebuilt AS (
    SELECT c.conv_id, list_concat(coalesce(g.own[1:c.h], []), c.own[c.h + 1:]) AS turns, list_concat(coalesce(g.b[1:c.h], []), c.b[c.h + 1:]) AS bytes
    FROM borrowing c LEFT JOIN listed g ON g.conv_id = c.conv_id - c.conv_id % 5),
prefixes AS (SELECT conv_id, d, turns[1:d] AS p, len(turns) AS n, coalesce(bytes[d], 0) AS cost FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)),
nodes AS (
    SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs, max(cost) AS cost, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = d) AS ends
    FROM prefixes GROUP BY p, d),
children AS (SELECT p[1:d - 1] AS p, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
weighed AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children, CASE WHEN n_children IS NULL THEN 1 ELSE 0 END AS leaf FROM nodes LEFT JOIN children USING (p)),
sums AS (
    SELECT p[1:up] AS p, sum(leaf) AS n_leaves, sum((n_convs - 1) * cost) AS saved
    FROM (SELECT *, unnest(range(0, d + 1)) AS up FROM weighed) GROUP BY ALL)
SELECT n.conv_id, n.d AS depth, q.conv_id AS parent_conv_id, n.n_convs, n.n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
FROM weighed n JOIN sums USING (p) LEFT JOIN nodes q ON n.d > 0 AND q.p = n.p[1:n.d - 1]
"""

SQL["op12_minhash"] = rf"""
WITH RECURSIVE texts AS (
    SELECT doc_id, coalesce(regexp_extract_all(translate(text, {UPPER_TO_LOWER}), '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE
        list_sort(list_distinct(list_transform(range(1, greatest(len(w) - 3, 1) + 1), lambda i: array_to_string(w[i:i + 3], ' ')))) END AS s
    FROM texts),
classed AS (SELECT doc_id, len(s) AS n, s, CASE WHEN len(s) > 0 THEN md5(array_to_string(s, chr(10))) END AS class FROM sets),
classes AS (SELECT class, any_value(s) AS s, any_value(n) AS n, min(doc_id) AS id FROM classed WHERE n > 0 GROUP BY class),
shingled AS (SELECT class, n, unnest(s) AS x FROM classes),
links AS (
    SELECT a.class AS u, b.class AS v FROM shingled a JOIN shingled b ON a.x = b.x AND a.class <> b.class
        AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
    GROUP BY a.class, b.class, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reached AS (
    SELECT class, class AS other FROM classes
    UNION SELECT reached.class, links.v FROM reached JOIN links ON links.u = reached.other),
components AS (SELECT reached.class, min(id) AS component FROM reached JOIN classes ON classes.class = reached.other GROUP BY reached.class)
SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, CASE WHEN n > 0 THEN component ELSE doc_id END AS component_id,
       coalesce(doc_id = CASE WHEN n > 0 THEN component ELSE doc_id END, FALSE) AS kept
FROM classed LEFT JOIN components USING (class)
"""
