"""The registered queries as DuckDB SQL, stated from the semantics and kept apart from the library.

Every query is a chain of named relations: the catalogue views over the star-schema tables, then the
steps of the build, then the query's own SELECT.
"""

from __future__ import annotations

# Catalogue views; verification.adapters states the same ones in DataFrame terms.
_VIEWS = {
    "recording": r"""
        SELECT id, md5('rec' || id) AS gid,
               CASE id_of_part % 4 WHEN 0 THEN p_name WHEN 1 THEN upper(p_name)
                    WHEN 2 THEN p_name || '!' ELSE replace(p_name, ' ', '  ') END AS name,
               CAST((length(p_name) + p_size % 2) % 10 AS BIGINT) AS artist_credit,
               CASE WHEN p_size <> 50 THEN CAST(round(p_retailprice * 250) AS INTEGER) END AS length
        FROM (SELECT *, p_partkey AS id, p_partkey AS id_of_part FROM part
              UNION ALL
              SELECT *, p_partkey + (SELECT count(*) FROM part), p_partkey
              FROM part WHERE p_partkey % 5 = 0)""",
    "medium": r"""
        SELECT DISTINCT l_orderkey * 2 + CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS id,
               l_orderkey AS release
        FROM lineitem""",
    "track": r"""
        SELECT CAST((l_orderkey * 8 + l_linenumber) * (2 * n) + rid AS BIGINT) AS id,
               rid AS recording,
               l_orderkey * 2 + CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS medium,
               p_name || ' (' || l_returnflag || ')' AS name,
               l_suppkey % 10 AS artist_credit
        FROM lineitem
        JOIN (SELECT p_partkey, p_name, p_partkey AS rid FROM part
              UNION ALL
              SELECT p_partkey, p_name, p_partkey + (SELECT count(*) FROM part)
              FROM part WHERE p_partkey % 5 = 0) ON l_partkey = p_partkey,
             (SELECT count(*) AS n FROM part)""",
    "release": r"""
        SELECT o_orderkey AS id, 'Vol. ' || (o_custkey % 50) || ': ' || o_orderpriority AS name,
               o_custkey % 10 AS artist_credit, o_custkey AS release_group,
               CASE WHEN o_orderstatus = 'F' AND o_orderkey % 8 = 0 THEN 1
                    WHEN o_orderstatus = 'O' THEN 2 END AS status
        FROM orders""",
    "release_group": r"""
        SELECT c_custkey AS id, md5('rg' || c_custkey) AS gid, c_name AS name,
               c_custkey % 10 AS artist_credit,
               CASE WHEN c_custkey % 13 = 0 THEN NULL
                    ELSE list_position(['MACHINERY', 'BUILDING', 'AUTOMOBILE', 'FURNITURE',
                                        'HOUSEHOLD'], c_mktsegment) END AS type
        FROM customer WHERE c_custkey % 11 <> 0""",
    "rg_type": r"""
        SELECT * FROM (VALUES (1, 'Album'), (2, 'EP'), (3, 'Single'), (4, 'Live'),
                              (5, 'Compilation')) t(id, name)""",
    "release_country": r"""
        SELECT o_orderkey AS release,
               CASE WHEN o_orderkey % 17 <> 0 THEN CAST(year(o_orderdate) AS INTEGER) END AS date_year,
               CASE WHEN o_orderkey % 7 <> 0 THEN CAST(month(o_orderdate) AS INTEGER) END AS date_month,
               CAST(CASE WHEN o_orderkey % 13 = 0 THEN 31 WHEN o_orderkey % 5 = 0 THEN 0
                         ELSE day(o_orderdate) END AS INTEGER) AS date_day
        FROM orders WHERE o_orderkey % 3 <> 1""",
    "release_unknown_country": r"""
        SELECT o_orderkey AS release, CAST(year(o_orderdate) AS INTEGER) AS date_year,
               CAST(month(o_orderdate) AS INTEGER) AS date_month, CAST(NULL AS INTEGER) AS date_day
        FROM orders WHERE o_orderkey % 4 = 0""",
    "artist": r"""
        SELECT s_suppkey AS id, md5('art' || s_suppkey) AS gid, s_name AS name FROM supplier""",
    "artist_credit_name": r"""
        SELECT s_suppkey AS artist_credit, 0 AS position, s_suppkey AS artist, s_name AS name
        FROM supplier
        UNION ALL
        SELECT s_suppkey, 1, (s_suppkey * 7 + 3) % (SELECT count(*) FROM supplier), s_name
        FROM supplier WHERE s_suppkey % 2 = 0""",
    "page_part": r"""
        SELECT page_id, regexp_replace(url, '^[a-z]+://[^/]+', '') AS suffix,
               regexp_replace(regexp_replace(url, '^[a-z]+://[^/]+', ''), '[?#].*', '') AS path
        FROM pages""",
    "url": r"""
        SELECT page_id AS id,
               CASE page_id % 5
                    WHEN 0 THEN 'https://open.spotify.com' || suffix
                    WHEN 1 THEN 'https://music.apple.com' || path || '?i=' || page_id || '&app=x'
                    WHEN 2 THEN 'https://music.apple.com' || suffix
                    WHEN 3 THEN 'https://tidal.com' || suffix
                    ELSE 'https://www.wikidata.org/wiki/'
                         || CASE WHEN page_id % 3 = 0 THEN '' ELSE 'Q' END || page_id END AS url
        FROM page_part""",
    "l_recording_url": r"""
        SELECT (page_id * 7) % (SELECT count(*) FROM part) AS entity0, page_id AS entity1 FROM pages
        UNION ALL
        SELECT (page_id * 11 + 1) % (SELECT count(*) FROM part), page_id
        FROM pages WHERE page_id % 3 = 0""",
    "l_artist_url": r"""
        SELECT (page_id // 5) % (SELECT count(*) FROM supplier) AS entity0, page_id AS entity1
        FROM pages
        UNION ALL
        SELECT ((page_id // 5) * 3) % 10, page_id FROM pages WHERE page_id % 2 = 0""",
    "play": r"""
        WITH line AS (
            SELECT l_orderkey, min(lpad(CAST(l_partkey AS VARCHAR), 12, '0') || l_returnflag) AS line
            FROM lineitem GROUP BY l_orderkey
        ), named AS (
            SELECT r.id AS o_orderkey, r.name AS album, s_name AS artist,
                   upper(p_name || ' (' || line[13] || ')') AS track
            FROM release r JOIN line ON l_orderkey = r.id
            JOIN part ON p_partkey = CAST(line[1:12] AS BIGINT)
            JOIN supplier ON s_suppkey = (length(p_name) + p_size % 2) % 10
        ), linked AS (
            SELECT u.id AS page_id,
                   CASE WHEN u.id % 5 = 0 THEN 'spotify:track:' || regexp_extract(path, '([^/]+)$', 1)
                        ELSE u.url END AS uri
            FROM url u JOIN page_part p ON p.page_id = u.id
        )
        SELECT event_id, user_id, CAST(round(value * 1000) AS INTEGER) AS ms_played,
               uri, track, album, artist
        FROM events
        LEFT JOIN linked ON event_id % 3 = 0 AND page_id = event_id % (SELECT count(*) FROM pages)
        LEFT JOIN named ON event_id % 3 = 1
             AND o_orderkey = (event_id * 8) % (SELECT count(*) FROM orders)""",
}


def _norm(text: str) -> str:
    kept = rf"regexp_replace(lower({text}), '[^\pL\pN \t\n\f\r]', '', 'g')"
    return rf"regexp_replace({kept}, '[ \t\n\f\r]+', ' ', 'g')"


def _date(y: str, m: str, d: str) -> str:
    """The repaired date, by calendar arithmetic instead of a caught error."""
    y, m, d = f"ifnull(nullif({y}, 0), 9999)", f"ifnull(nullif({m}, 0), 1)", f"ifnull(nullif({d}, 0), 1)"
    text = f"printf('%04d-%02d-%02d', {y}, {m}, {d})"
    return f"ifnull(TRY_CAST({text} AS DATE), DATE '9999-12-31')"


_BUCKET = "round(ifnull(length, 0) / 5000.0::DOUBLE)"

_APPLE = r"contains({u}, 'apple') AND regexp_matches({u}, '[?&]i=[0-9]+')"
_IDENTIFIER = (
    rf"CASE WHEN {_APPLE} THEN regexp_extract({{u}}, '[?&]i=([0-9]+)', 1) "
    r"ELSE regexp_extract(regexp_replace({u}, '[?#].*', ''), '([^/{colon}]+)$', 1) END"
)
_PROVIDER = (
    "CASE WHEN contains({u}, 'spotify') THEN 'spotify' WHEN contains({u}, 'apple') THEN 'applemusic' "
    "WHEN contains({u}, 'tidal') THEN 'tidal' ELSE 'unknown' END"
)


def _identifier(url: str, uri: bool = False) -> str:
    return _IDENTIFIER.format(u=url, colon=":" if uri else "")


def _provider(url: str) -> str:
    return _PROVIDER.format(u=url)


# Steps of the build.
_STEPS = {
    "rec": f"""
        SELECT id, gid, artist_credit, length, {_norm('name')} AS normalized_name,
               {_BUCKET} AS length_bucket
        FROM recording""",
    "dates": f"""
        SELECT release, min({_date('date_year', 'date_month', 'date_day')}) AS normalized_release_date
        FROM (FROM release_country UNION ALL FROM release_unknown_country)
        GROUP BY release""",
    # Score by type.
    "score": """
        SELECT * FROM (VALUES ('Album', 1000), ('EP', 900), ('Single', 800), ('Soundtrack', 700),
            ('Other', 600), ('Broadcast', 500), ('Audio Drama', 400), ('Audiobook', 300),
            ('Spokenword', 200), ('Interview', 100), ('Demo', 50), ('Live', -1000), ('Remix', -1100),
            ('DJ-mix', -1200), ('Mixtape/Street', -1300), ('Compilation', -1400)) t(type_name, points)""",
    "album": """
        SELECT g.id, g.gid, g.name, g.artist_credit, t.name AS type_name,
               ifnull(points, 0) AS points
        FROM release_group g LEFT JOIN rg_type t ON t.id = g.type
        LEFT JOIN score ON score.type_name = t.name""",
    "scored": """
        SELECT rec.gid AS recording_mbid, rec.length AS raw_length, album.gid AS release_group_mbid,
               album.name AS release_group_title, album.type_name AS release_group_type,
               album.artist_credit AS release_group_artist_credit,
               rec.normalized_name AS normalized_rec_name, rec.artist_credit, rec.length_bucket,
               CAST(ifnull(points, 0)
                    + 50 * CAST(ifnull(album.artist_credit = rec.artist_credit, FALSE) AS INTEGER)
                    AS INTEGER) AS evaluation_score,
               ifnull(dates.normalized_release_date, DATE '9999-12-31') AS normalized_release_date
        FROM release
        JOIN medium ON medium.release = release.id AND release.status = 1
        JOIN track ON track.medium = medium.id
        JOIN rec ON rec.id = track.recording
        LEFT JOIN dates ON dates.release = release.id
        LEFT JOIN album ON album.id = release.release_group""",
    "rank": """
        SELECT DISTINCT ON (normalized_rec_name, artist_credit, length_bucket)
               normalized_rec_name, artist_credit, length_bucket,
               recording_mbid AS canonical_recording_mbid, release_group_mbid, release_group_title,
               release_group_type, release_group_artist_credit, raw_length AS length
        FROM scored
        ORDER BY normalized_rec_name, artist_credit, length_bucket, evaluation_score DESC,
                 normalized_release_date, release_group_mbid NULLS LAST, recording_mbid""",
    "member": """
        SELECT DISTINCT rec.id AS recording_id, rec.gid AS recording_mbid, canonical_recording_mbid
        FROM rank JOIN rec ON (rec.normalized_name, rec.artist_credit, rec.length_bucket)
             = (rank.normalized_rec_name, rank.artist_credit, rank.length_bucket)""",
    "wikidata": """
        SELECT l.entity0 AS artist_id, regexp_extract(url.url, '(Q[0-9]+)', 1) AS wikidata_id
        FROM url JOIN l_artist_url l ON l.entity1 = url.id AND contains(url.url, 'wikidata.org')""",
    "out_release_group": """
        SELECT release_group_mbid, min(release_group_title) AS release_group_title,
               min(release_group_type) AS release_group_type
        FROM rank WHERE release_group_mbid IS NOT NULL GROUP BY 1""",
    "credit": """
        SELECT n.artist_credit, n.position, a.gid AS artist_mbid, a.name AS artist_name
        FROM artist_credit_name n JOIN artist a ON a.id = n.artist""",
    "out_recording_artists": """
        SELECT rec.gid AS recording_mbid, credit.artist_mbid, credit.position
        FROM rec JOIN credit USING (artist_credit)
        WHERE EXISTS (SELECT 1 FROM rank WHERE canonical_recording_mbid = rec.gid)""",
    "out_release_group_artists": """
        SELECT g.release_group_mbid, credit.artist_mbid, credit.position
        FROM (SELECT DISTINCT release_group_mbid, release_group_artist_credit AS artist_credit
              FROM rank WHERE release_group_mbid IS NOT NULL) g
        JOIN credit USING (artist_credit)""",
    "out_artists": """
        SELECT a.gid AS artist_mbid, min(a.name) AS artist_name,
               ifnull(min(nullif(w.wikidata_id, '')), min(w.wikidata_id)) AS artist_wikidata_id
        FROM artist a LEFT JOIN wikidata w ON w.artist_id = a.id
        WHERE EXISTS (SELECT 1 FROM out_recording_artists c WHERE c.artist_mbid = a.gid)
           OR EXISTS (SELECT 1 FROM out_release_group_artists c WHERE c.artist_mbid = a.gid)
        GROUP BY a.gid""",
    "out_recording": """
        SELECT canonical_recording_mbid AS recording_mbid, min(release_group_mbid) AS release_group_mbid,
               min(rank.length) AS length, min(credit.artist_mbid) AS primary_artist_mbid
        FROM rank JOIN rec ON rec.gid = canonical_recording_mbid
        LEFT JOIN credit ON credit.artist_credit = rec.artist_credit AND credit.position = 0
        WHERE release_group_mbid IS NOT NULL
        GROUP BY 1""",
    "out_text_lookup": f"""
        SELECT DISTINCT {_norm('track.name')} AS track_title, {_norm('release.name')} AS release_title,
               {_norm('credit.artist_name')} AS artist_name,
               member.canonical_recording_mbid AS recording_mbid
        FROM release
        JOIN medium ON medium.release = release.id AND release.status = 1
        JOIN track ON track.medium = medium.id
        JOIN member ON member.recording_id = track.recording
        JOIN rec ON rec.id = track.recording
        JOIN credit ON credit.artist_credit = rec.artist_credit AND credit.position = 0""",
    "out_link_lookup": f"""
        SELECT DISTINCT {_identifier('url.url')} AS url_identifier, {_provider('url.url')} AS provider,
               member.canonical_recording_mbid AS recording_mbid
        FROM l_recording_url l
        JOIN url ON url.id = l.entity1
             AND regexp_matches(url.url, 'spotify|apple|tidal')
        JOIN member ON member.recording_id = l.entity0""",
    "resolved": f"""
        SELECT event_id, user_id, ms_played, ifnull(by_link.mbid, by_text.mbid) AS recording_mbid,
               CASE WHEN by_link.mbid IS NOT NULL THEN 'link'
                    WHEN by_text.mbid IS NOT NULL THEN 'text' END AS matched_by
        FROM play
        LEFT JOIN (SELECT DISTINCT ON (provider, url_identifier) provider, url_identifier,
                          recording_mbid AS mbid
                   FROM out_link_lookup LEFT JOIN out_recording USING (recording_mbid)
                   ORDER BY provider, url_identifier, release_group_mbid IS NULL, mbid) by_link
               ON by_link.provider = {_provider('play.uri')}
              AND by_link.url_identifier = {_identifier('play.uri', uri=True)}
        LEFT JOIN (SELECT DISTINCT ON (track_title, release_title, artist_name)
                          track_title, release_title, artist_name, recording_mbid AS mbid
                   FROM out_text_lookup LEFT JOIN out_recording USING (recording_mbid)
                   ORDER BY track_title, release_title, artist_name,
                            release_group_mbid IS NULL, mbid) by_text
               ON by_text.track_title = {_norm('play.track')}
              AND by_text.release_title = {_norm('play.album')}
              AND by_text.artist_name = {_norm('play.artist')}""",
    # The sampler's key sets.
    "s_release": "SELECT * FROM release ORDER BY id LIMIT 50",
    "s_medium": "SELECT id FROM medium WHERE release IN (SELECT id FROM s_release)",
    "s_track": "SELECT * FROM track WHERE medium IN (SELECT id FROM s_medium)",
    "s_credit": """
        SELECT artist_credit AS id FROM s_release
        UNION SELECT artist_credit FROM s_track
        UNION SELECT artist_credit FROM recording WHERE id IN (SELECT recording FROM s_track)
        UNION SELECT artist_credit FROM release_group
              WHERE id IN (SELECT release_group FROM s_release)""",
    "s_artist": """
        SELECT DISTINCT artist AS id FROM artist_credit_name
        WHERE artist_credit IN (SELECT id FROM s_credit)""",
    "s_recording_url": """
        SELECT * FROM l_recording_url WHERE entity0 IN (SELECT recording FROM s_track)""",
    "s_artist_url": "SELECT * FROM l_artist_url WHERE entity0 IN (SELECT id FROM s_artist)",
    "s_url": "SELECT entity1 AS id FROM s_recording_url UNION SELECT entity1 FROM s_artist_url",
}


def _query(select: str) -> str:
    relations = {**_VIEWS, **_STEPS}
    chain = ",\n".join(f"{name} AS ({body})" for name, body in relations.items())
    return f"WITH {chain}\n{select}"


def _rows(table: str) -> str:
    return f"(SELECT count(*) FROM {table})"


def _values(names: str, *rows: str) -> str:
    return f"SELECT * FROM (VALUES {', '.join(f'({r})' for r in rows)}) t({names})"


_KEYED = {
    "release_group": "release_group_mbid",
    "recording": "recording_mbid",
    "artists": "artist_mbid",
    "link_lookup": "provider, url_identifier, recording_mbid",
}
_REQUIRED = {
    "release_group": ["release_group_title"],
    "recording": ["release_group_mbid"],
    "artists": ["artist_name"],
    "recording_artists": ["recording_mbid", "artist_mbid", "position"],
    "release_group_artists": ["release_group_mbid", "artist_mbid", "position"],
    "link_lookup": ["url_identifier", "provider", "recording_mbid"],
    "text_lookup": ["track_title", "release_title", "artist_name", "recording_mbid"],
}
_REFERENCES = [
    ("recording", "primary_artist_mbid", "artists", "artist_mbid"),
    ("recording", "release_group_mbid", "release_group", "release_group_mbid"),
    ("recording_artists", "artist_mbid", "artists", "artist_mbid"),
    ("release_group_artists", "artist_mbid", "artists", "artist_mbid"),
    ("recording_artists", "recording_mbid", "recording", "recording_mbid"),
    ("release_group_artists", "release_group_mbid", "release_group", "release_group_mbid"),
    ("text_lookup", "recording_mbid", "recording", "recording_mbid"),
    ("link_lookup", "recording_mbid", "recording", "recording_mbid"),
    ("release_group", "release_group_mbid", "recording", "release_group_mbid"),
]


def _built(table: str) -> str:
    """An output table as the build writes it: with its version, the text lookup with dense ids."""
    ids = "row_number() OVER (ORDER BY track_title, artist_name, release_title, recording_mbid) AS id, "
    return f"SELECT {ids if table == 'text_lookup' else ''}*, '20260101-000000' AS dump_version FROM out_{table}"


_PLAYS = "SELECT event_id, user_id, CAST(ms_played AS BIGINT) AS ms_played, uri, track, album, artist FROM play"


def _orphan_row(child: str, column: str, parent: str, key: str) -> str:
    return (
        f"SELECT '{child}.{column} in {parent}' AS rule, count(DISTINCT {column}) AS orphan_keys, "
        f"count({column}) AS orphan_rows FROM out_{child} c "
        f"WHERE NOT EXISTS (SELECT 1 FROM out_{parent} p WHERE p.{key} = c.{column})"
    )


def _credits(owner: str, table: str) -> str:
    return (
        f"SELECT c.{owner}, c.position, c.artist_mbid, a.artist_name, a.artist_wikidata_id "
        f"FROM {table} c JOIN out_artists a USING (artist_mbid)"
    )


_SAMPLED = {
    "release": "release WHERE id IN (SELECT id FROM s_release)",
    "medium": "s_medium",
    "track": "s_track",
    "recording": "recording WHERE id IN (SELECT recording FROM s_track)",
    "release_group": "release_group WHERE id IN (SELECT release_group FROM s_release)",
    "artist_credit_name": "artist_credit_name WHERE artist_credit IN (SELECT id FROM s_credit)",
    "artist": "artist WHERE id IN (SELECT id FROM s_artist)",
    "url": "url WHERE id IN (SELECT id FROM s_url)",
    "l_recording_url": "s_recording_url",
    "l_artist_url": "s_artist_url",
    "rg_type": "rg_type",
    "release_country": "release_country WHERE release IN (SELECT id FROM s_release)",
    "release_unknown_country": "release_unknown_country WHERE release IN (SELECT id FROM s_release)",
}
_TABLES = [name for name in _VIEWS if name not in ("page_part", "play")]

_SELECTS = {
    "norm_text": f"""
        SELECT 'd' || doc_id AS text_id, {_norm('text')} AS normalized FROM documents
        UNION ALL
        SELECT 'c-' || conv_id || '-' || turn, {_norm('text')} FROM conversations""",
    "length_bucket": f"SELECT id, length, {_BUCKET} AS length_bucket FROM recording",
    "repair_date": f"""
        SELECT release, date_year, date_month, date_day,
               {_date('date_year', 'date_month', 'date_day')} AS repaired_date
        FROM release_country""",
    "earliest_dates": "FROM dates",
    "official_releases": "SELECT id, release_group, artist_credit FROM release WHERE status = 1",
    "release_names": "SELECT id, name FROM release",
    "type_score": """
        SELECT r.id, album.type_name AS release_group_type,
               CAST(ifnull(points, 0) AS INTEGER) AS base_score,
               CASE WHEN album.artist_credit = r.artist_credit THEN 50 ELSE 0 END AS bonus
        FROM release r LEFT JOIN album ON album.id = r.release_group""",
    "url_identifier": f"SELECT id, {_identifier('url')} AS url_identifier FROM url",
    "url_provider": f"""
        SELECT id, {_provider('url')} AS provider,
               regexp_matches(url, 'spotify|apple|tidal') AS known
        FROM url""",
    "wikidata_ids": "FROM wikidata",
    "normalize_recordings": "FROM rec",
    "scored_candidates": "FROM scored",
    "canonical_rank": "FROM rank",
    "canonical_map": "FROM member",
    "dim_release_group": "FROM out_release_group",
    "dim_artist": "FROM out_artists",
    "dim_recording": "FROM out_recording",
    "recording_credits": "FROM out_recording_artists",
    "release_group_credits": "FROM out_release_group_artists",
    "text_lookup": "FROM out_text_lookup",
    "link_lookup": "FROM out_link_lookup",
    "load_audit": _values("table_name, row_count", *[f"'{t}', {_rows(t)}" for t in _TABLES]),
    "tsv_scan": """
        SELECT CAST(r.id AS INTEGER) AS id, r.gid, r.name,
               CAST(r.artist_credit AS INTEGER) AS artist_credit, r.length, t.tracks, t.first_track
        FROM recording r
        LEFT JOIN (SELECT recording, count(*) AS tracks, min(name) AS first_track
                   FROM track GROUP BY recording) t ON t.recording = r.id""",
    "pk_violations": _values(
        "table_name, violations",
        *[
            f"'{t}', (SELECT count(*) FROM (SELECT 1 FROM out_{t} GROUP BY {k} HAVING count(*) > 1))"
            for t, k in _KEYED.items()
        ],
    ),
    "not_null_violations": _values(
        "table_name, column_name, violations",
        *[
            f"'{t}', '{c}', (SELECT count(*) FROM out_{t} WHERE {c} IS NULL)"
            for t, columns in _REQUIRED.items()
            for c in columns
        ],
    ),
    "orphans": "\nUNION ALL\n".join(_orphan_row(*r) for r in _REFERENCES),
    "lookup_cardinality": """
        SELECT recording_mbid,
               (SELECT count(*) FROM out_link_lookup l WHERE l.recording_mbid = r.recording_mbid) AS links,
               (SELECT count(*) FROM out_text_lookup t WHERE t.recording_mbid = r.recording_mbid) AS texts
        FROM out_recording r""",
    "closed_sample_stats": _values(
        "key_set, key_count",
        "'releases', (SELECT count(*) FROM s_release)",
        "'release_groups', (SELECT count(DISTINCT release_group) FROM s_release)",
        "'mediums', (SELECT count(*) FROM s_medium)",
        "'tracks', (SELECT count(DISTINCT id) FROM s_track)",
        "'recordings', (SELECT count(DISTINCT recording) FROM s_track)",
        "'artist_credits', (SELECT count(*) FROM s_credit)",
        "'artists', (SELECT count(*) FROM s_artist)",
        "'urls', (SELECT count(*) FROM s_url)",
    ),
    "closed_sample_counts": _values(
        "table_name, row_count",
        *[f"'{t}', (SELECT count(*) FROM {source})" for t, source in _SAMPLED.items()],
    ),
    "closed_sample_track": "FROM s_track",
    "history_resolve": """
        SELECT resolved.*, out_recording.release_group_mbid
        FROM resolved LEFT JOIN out_recording USING (recording_mbid)""",
    "plays_per_release_group": """
        SELECT release_group_mbid, min(release_group_title) AS release_group_title,
               count(*) AS plays, CAST(sum(ms_played) AS BIGINT) AS ms_played
        FROM resolved LEFT JOIN out_recording USING (recording_mbid)
        LEFT JOIN out_release_group USING (release_group_mbid)
        GROUP BY release_group_mbid""",
    "ordered_credits": _credits("recording_mbid", "out_recording_artists"),
    "release_group_ordered_credits": _credits("release_group_mbid", "out_release_group_artists"),
    "track_details": """
        SELECT r.recording_mbid, r.length, r.release_group_mbid, g.release_group_title,
               r.primary_artist_mbid, a.artist_wikidata_id AS primary_artist_wikidata_id
        FROM out_recording r LEFT JOIN out_release_group g USING (release_group_mbid)
        LEFT JOIN out_artists a ON a.artist_mbid = r.primary_artist_mbid""",
    "history_scan": _PLAYS,
    "history_scan_lines": _PLAYS,
}
_SELECTS |= {f"built_{table}": _built(table) for table in _REQUIRED}
_SELECTS |= {f"salted_{table}": f"FROM out_{table}" for table in _REQUIRED}
_SELECTS |= {f"delta_{table}": f"FROM out_{table}" for table in ("recording", "text_lookup", "link_lookup", "artists")}
_SELECTS |= {
    "built_load_audit": _SELECTS["load_audit"],
    "built_layout": "SELECT 'link_lookup' AS table_name, 'provider=' || provider AS folder, 'zstd' AS codec, "
    "count(*) AS row_count FROM out_link_lookup GROUP BY provider"
    + "".join(
        f" UNION ALL SELECT '{table}', '', 'zstd', count(*) FROM out_{table}"
        for table in _REQUIRED
        if table != "link_lookup"
    ),
    "sampled_dump": _SELECTS["closed_sample_counts"],
    # The ids of the text lookup are dense by definition.
    "built_pk_violations": _SELECTS["pk_violations"] + " UNION ALL SELECT 'text_lookup', 0",
    "built_not_null_violations": _SELECTS["not_null_violations"] + " UNION ALL SELECT 'text_lookup', 'id', 0",
}

ORACLE_SQL = {name: _query(select) for name, select in _SELECTS.items()}
