"""DuckDB statements for the queries of the operators that SQL can express."""

STATEMENTS = {
    "op7_exact_dedup": """
        WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
        SELECT doc_id,
               max(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept,
               text_sha256
        FROM d WINDOW same AS (PARTITION BY text_sha256)
    """,
    "op1_mix": r"""
        WITH RECURSIVE sized AS (
            SELECT doc_id, source,
                   coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
                   md5('17:' || coalesce(doc_id::VARCHAR, '')) AS key
            FROM documents
        ),
        sources AS (
            SELECT source, sum(size)::BIGINT AS source_size,
                   [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight
            FROM sized GROUP BY source
        ),
        rounds AS (
            SELECT 0 AS n, sum(source_size)::DOUBLE AS whole, sum(source_size)::DOUBLE AS words, sum(weight) AS weight, 0::BIGINT AS clamped
            FROM sources
            UNION ALL
            SELECT any_value(r.n) + 1, any_value(r.whole),
                   any_value(r.whole) - coalesce(sum(s.source_size * 3.0) FILTER (s.weight * r.words / r.weight > s.source_size * 3.0), 0),
                   coalesce(sum(s.weight) FILTER (s.weight * r.words / r.weight <= s.source_size * 3.0), 0),
                   count(*) FILTER (s.weight * r.words / r.weight > s.source_size * 3.0)
            FROM rounds r, sources s
            WHERE r.weight > 0 AND r.n <= (SELECT count(*) FROM sources)
            GROUP BY r.n
        ),
        settled AS (SELECT words, weight AS weights FROM rounds ORDER BY n DESC LIMIT 1),
        plan AS (
            SELECT source, source_size,
                   CASE WHEN weights > 0 THEN least(source_size * 3.0, weight * words / weights) ELSE source_size * 3.0 END::DOUBLE AS target
            FROM sources, settled
        ),
        budget AS (
            SELECT *, coalesce(round(target)::BIGINT // nullif(source_size, 0), 0) AS whole,
                   round(target)::BIGINT - coalesce(round(target)::BIGINT // nullif(source_size, 0), 0) * source_size AS part
            FROM plan
        ),
        running AS (
            SELECT d.doc_id, d.size, b.source_size, b.target, b.whole, b.part,
                   sum(d.size) OVER (PARTITION BY b.source ORDER BY d.key, d.size ROWS UNBOUNDED PRECEDING) - d.size AS before
            FROM sized d JOIN budget b ON d.source IS NOT DISTINCT FROM b.source
        ),
        more AS (SELECT *, greatest(0, least(size, part - before))::BIGINT AS extra FROM running)
        SELECT doc_id, size, source_size, target, (whole * size + extra)::BIGINT AS taken,
               (whole + CASE WHEN extra = size AND size > 0 THEN 1 ELSE 0 END)::BIGINT AS repeats,
               (CASE WHEN extra = size THEN 0 ELSE extra END)::BIGINT AS part_words
        FROM more
    """,
    "op8_quality": r"""
        WITH d AS (
            SELECT row_number() OVER () AS row_id, doc_id, source, coalesce(text, '') AS text,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
            FROM documents
        ),
        counted AS (
            SELECT row_id, doc_id, source, text, len(words)::BIGINT AS n_words,
                   length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
                   len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols
            FROM d
        ),
        windows AS (
            SELECT row_id, place, array_to_string(words[place:place + 7], ' ') AS win
            FROM (SELECT row_id, words, unnest(range(1, len(words) - 6)) AS place FROM d WHERE len(words) >= 8)
        ),
        again AS (SELECT row_id, place, count(*) OVER (PARTITION BY row_id, win) AS n FROM windows),
        steps AS (
            SELECT row_id, least(8, coalesce(lead(place) OVER (PARTITION BY row_id ORDER BY place) - place, 8)) AS step
            FROM again WHERE n > 1
        ),
        repeated AS (SELECT row_id, sum(step)::BIGINT AS n_repeat_words FROM steps GROUP BY row_id),
        lines AS (
            SELECT row_id, source, md5(text) AS text_hash, line,
                   len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words,
                   trim(regexp_replace(lower(line), '[\x20\x09-\x0D]+', ' ', 'g')) AS norm
            FROM (SELECT row_id, source, text, unnest(string_split(text, chr(10))) AS line FROM d)
            WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
        ),
        doubled AS (SELECT row_id, (count(*) - count(DISTINCT line))::BIGINT AS n_dup_lines FROM lines GROUP BY row_id),
        frequent AS (SELECT source, norm FROM lines GROUP BY source, norm HAVING count(DISTINCT text_hash) > 20),
        removed AS (
            SELECT row_id, sum(words) AS n_removed
            FROM lines l JOIN frequent f ON l.source IS NOT DISTINCT FROM f.source AND l.norm = f.norm GROUP BY row_id
        ),
        judged AS (
            SELECT doc_id, n_words, word_chars, n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
                   coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
                   (n_words - coalesce(n_removed, 0))::BIGINT AS n_left,
                   n_words < 20 OR 100 * coalesce(n_repeat_words, 0) > 30 * n_words AS base_failed
            FROM counted LEFT JOIN repeated USING (row_id) LEFT JOIN doubled USING (row_id) LEFT JOIN removed USING (row_id)
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT base_failed AND n_left >= 0.3::DOUBLE * n_words AS kept, n_left
        FROM judged
    """,
    "op10_urls": r"""
        WITH parts AS (
            SELECT page_id,
                   CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest,
                   regexp_extract(url, '/([0-9]{1,18})(?:[^0-9]|$)', 1) AS number
            FROM pages
        ),
        p AS (
            SELECT page_id, number,
                   translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM parts
        ),
        rules(rule, of, start, outcome) AS (
            VALUES ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
                   ('www.example.com/en/', 'www.example.com', '/en/', 'allow'),
                   ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')
        ),
        fitting AS (
            SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(outcome, length(rule)) AS outcome
            FROM p JOIN rules ON (host = of OR ends_with(host, '.' || of)) AND starts_with(path, start)
            GROUP BY page_id
        ),
        outcomes AS (
            SELECT host, 1 - quality AS bad
            FROM p JOIN labels ON number <> '' AND labels.doc_id = try_cast(number AS BIGINT) WHERE quality IS NOT NULL
        ),
        named AS (
            SELECT host, CASE WHEN regexp_full_match(host, '[0-9.:\[\]]*') THEN host ELSE array_to_string(string_split(host, '.')[CASE WHEN two THEN -3 ELSE -2 END:], '.') END AS domain,
                   CASE WHEN regexp_full_match(host, '[0-9.:\[\]]*') THEN host ELSE array_to_string(string_split(host, '.')[CASE WHEN two THEN -2 ELSE -1 END:], '.') END AS suffix
            FROM (SELECT DISTINCT host, regexp_matches(host, '(?:^|[.])(?:ac|co|com|edu|go|gob|gov|ltd|mil|ne|net|or|org|plc|sch)[.][a-z][a-z]$') AS two FROM p)
        ),
        h AS (SELECT n.*, count(bad) AS n, coalesce(sum(bad), 0) AS x FROM outcomes o JOIN named n USING (host) GROUP BY ALL),
        r0 AS (SELECT (coalesce(sum(x), 0) + 1) / (coalesce(sum(n), 0) + 2) AS rate FROM h),
        g1 AS (SELECT suffix, rate AS up, sum(n) AS n, sum(x) AS x FROM h, r0 GROUP BY ALL),
        k1 AS (SELECT 1 / greatest(1e-4, least(0.5, CASE WHEN sum(up * (1 - up) * n * (n - 1)) > 0
                      THEN sum((x - n * up) ** 2 - up * (1 - up) * n) / sum(up * (1 - up) * n * (n - 1)) ELSE 1e-4 END)) - 1 AS k FROM g1),
        r1 AS (SELECT suffix, (x + k * up) / (n + k) AS rate FROM g1, k1),
        g2 AS (SELECT domain, rate AS up, sum(n) AS n, sum(x) AS x FROM h JOIN r1 USING (suffix) GROUP BY ALL),
        k2 AS (SELECT 1 / greatest(1e-4, least(0.5, CASE WHEN sum(up * (1 - up) * n * (n - 1)) > 0
                      THEN sum((x - n * up) ** 2 - up * (1 - up) * n) / sum(up * (1 - up) * n * (n - 1)) ELSE 1e-4 END)) - 1 AS k FROM g2),
        r2 AS (SELECT domain, (x + k * up) / (n + k) AS rate FROM g2, k2),
        g3 AS (SELECT host, rate AS up, n, x FROM h JOIN r2 USING (domain)),
        k3 AS (SELECT 1 / greatest(1e-4, least(0.5, CASE WHEN sum(up * (1 - up) * n * (n - 1)) > 0
                      THEN sum((x - n * up) ** 2 - up * (1 - up) * n) / sum(up * (1 - up) * n * (n - 1)) ELSE 1e-4 END)) - 1 AS k FROM g3),
        r3 AS (SELECT host, (x + k * up) / (n + k) AS rate, n + k AS weight FROM g3, k3),
        rated AS (
            SELECT host, coalesce(r3.rate, r2.rate, r1.rate, 0.5) AS rate,
                   CASE WHEN r3.host IS NOT NULL THEN r3.weight WHEN r2.domain IS NOT NULL THEN k3.k
                        WHEN r1.suffix IS NOT NULL THEN k2.k ELSE 0 END AS weight
            FROM named LEFT JOIN r3 USING (host) LEFT JOIN r2 USING (domain) LEFT JOIN r1 USING (suffix), k2, k3
        )
        SELECT p.page_id, p.host, p.path, rule,
               coalesce(outcome, CASE WHEN rate - 1.645 * sqrt(rate * (1 - rate) / (weight + 1)) > 0.5 THEN 'block' ELSE 'allow' END) AS verdict
        FROM p JOIN rated USING (host) LEFT JOIN fitting USING (page_id)
    """,
    "op13_phrases": r"""
        WITH pieces AS (
            SELECT lang, row_number() OVER () AS piece_id, regexp_extract_all(piece, '[^\x20\x09]+') AS words
            FROM (
                SELECT coalesce(lang, 'und') AS lang,
                       unnest(regexp_split_to_array(
                           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                           '[.,;:!?\x0A-\x0D]')) AS piece
                FROM documents
            )
        ),
        totals AS (SELECT lang, sum(len(words))::BIGINT AS n FROM pieces GROUP BY lang),
        places AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS place FROM pieces),
        counts AS (
            SELECT lang, size, array_to_string(words[place:place + size - 1], ' ') AS phrase, count(*) AS f
            FROM places, range(1, 6) sizes(size)
            WHERE place + size - 1 <= len(words)
            GROUP BY ALL HAVING count(*) >= 100
        ),
        candidates AS (SELECT *, string_split(phrase, ' ') AS words FROM counts WHERE size > 1),
        inside AS (
            SELECT DISTINCT lang, f, array_to_string(words[start:start + part - 1], ' ') AS phrase
            FROM candidates, range(2, 5) parts(part), range(1, 5) starts(start)
            WHERE part < size AND start + part - 1 <= size
        ),
        kept AS (
            SELECT c.* FROM candidates c
            WHERE NOT EXISTS (SELECT 1 FROM inside i WHERE i.lang = c.lang AND i.phrase = c.phrase AND i.f >= c.f)
        ),
        cuts AS (
            SELECT k.lang, k.phrase, k.f AS a, cut, x.f AS l, y.f AS r, n, ((1000::HUGEINT * k.f * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
            FROM kept k JOIN range(1, 5) parted(cut) ON cut < k.size
            JOIN counts x ON x.lang = k.lang AND x.phrase = array_to_string(k.words[:cut], ' ')
            JOIN counts y ON y.lang = k.lang AND y.phrase = array_to_string(k.words[cut + 1:], ' ')
            JOIN totals t ON t.lang = k.lang
        ),
        weakest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM weakest)
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
    """,
}
