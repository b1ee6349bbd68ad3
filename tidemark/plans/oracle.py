"""DuckDB SQL with the same answers, keyed as the queries are."""

from __future__ import annotations

ORACLE: dict[str, str] = {}


def top_10(table: str, key: str) -> str:
    return f"""
        SELECT {key}, count(*) AS n FROM {table}
        GROUP BY {key} ORDER BY n DESC, {key} LIMIT 10"""


def median(table: str, key: str) -> str:
    return f"""
        SELECT median(n) AS median
        FROM (SELECT count(*) AS n FROM {table} GROUP BY {key})"""


def largest(table: str, key: str) -> str:
    return f"SELECT max(n) AS n FROM (SELECT count(*) AS n FROM {table} GROUP BY {key})"


ORACLE["q01_row_count"] = "SELECT count(*) AS n FROM lineitem"
ORACLE["q02_distinct_customers"] = "SELECT count(DISTINCT o_custkey) AS n FROM orders"
ORACLE["q03_distinct_products"] = "SELECT count(DISTINCT l_partkey) AS n FROM lineitem"
ORACLE["q04_largest_customer"] = largest("orders", "o_custkey")
ORACLE["q05_largest_product"] = largest("lineitem", "l_partkey")
ORACLE["q06_top_customers"] = top_10("orders", "o_custkey")
ORACLE["q07_top_products"] = top_10("lineitem", "l_partkey")
ORACLE["q08_median_customer"] = median("orders", "o_custkey")
ORACLE["q09_median_product"] = median("lineitem", "l_partkey")

SPLIT = """list_filter(
        string_split_regex(coalesce(text, ''), '[.?!]'), lambda s: s <> '')"""


def reviews(customers: int, product: str) -> str:
    return f"""
    reviews AS (
        SELECT *, len(body) AS num_sentences
        FROM (SELECT doc_id AS review_id, n_chars % {customers} AS customer_id,
                     {product} AS product_id, {SPLIT} AS body
              FROM documents))"""


def cascade(
    customers: int, product: str, least: int, customer_above: str, product_above: str
) -> str:
    return f"""{reviews(customers, product)},
    long_enough AS (SELECT * FROM reviews WHERE num_sentences >= {least}),
    by_customer AS (
        SELECT * FROM long_enough WHERE customer_id IN (
            SELECT customer_id FROM long_enough GROUP BY customer_id
            HAVING count(*) > {customer_above})),
    active AS (
        SELECT * FROM by_customer WHERE product_id IN (
            SELECT product_id FROM by_customer GROUP BY product_id
            HAVING count(*) > {product_above}))"""


BY_MEDIAN = cascade(
    50,
    "lang",
    2,
    f"({median('reviews', 'customer_id')})",
    f"({median('reviews', 'product_id')})",
)
BY_NUMBER = cascade(997, "source", 3, "1", "2")
SHOWN = "SELECT review_id, customer_id, product_id, num_sentences"

ORACLE["q10_sentences"] = f"""
    WITH {reviews(50, 'lang')}
    SELECT review_id, num_sentences, array_to_string(body, '|') AS sentences
    FROM reviews"""
ORACLE["q11_min_sentences"] = f"""
    WITH {reviews(50, 'lang')} {SHOWN} FROM reviews WHERE num_sentences >= 2"""
ORACLE["q12_active_by_median"] = f"WITH {BY_MEDIAN} {SHOWN} FROM active"
ORACLE["q13_active_by_number"] = f"WITH {BY_NUMBER} {SHOWN} FROM active"


def top_by_median(key: str) -> str:
    return f"""
    WITH {BY_NUMBER}
    SELECT {key}, cast(trunc(median(num_sentences)) AS int) AS median
    FROM active GROUP BY {key} ORDER BY median DESC, {key} LIMIT 10"""


ORACLE["q14_top_customers_by_sentences"] = top_by_median("customer_id")
ORACLE["q15_top_products_by_sentences"] = top_by_median("product_id")

CLASSED = f"""{BY_MEDIAN},
    rated AS (
        SELECT active.*, 1 + 4 * quality AS star_rating
        FROM active JOIN labels ON review_id = doc_id
        WHERE product_id = 'en'),
    classed AS (
        SELECT *, CASE WHEN star_rating > 3 THEN 'positive' ELSE 'negative' END AS sentiment
        FROM rated WHERE star_rating <> 3),
    exploded AS (
        SELECT sentiment, review_id, cast(i - 1 AS int) AS pos, body[i] AS sentence
        FROM (SELECT *, unnest(generate_series(1, len(body))) AS i FROM classed)),
    trimmed AS (
        SELECT sentiment, review_id, pos, trim(sentence, ' ') AS sentence
        FROM exploded WHERE sentence <> ' ')"""
ORACLE["q16_class_split"] = f"""
    WITH {CLASSED} SELECT sentiment, review_id, star_rating, num_sentences FROM classed"""
ORACLE["q17_trimmed_sentences"] = f"WITH {CLASSED} SELECT * FROM trimmed"
ORACLE["q18_tokens"] = f"""
    WITH {CLASSED},
    tokenised AS (
        SELECT *, regexp_extract_all(lower(sentence), '\\w+') AS tokens FROM trimmed)
    SELECT sentiment, review_id, pos, cast(len(tokens) AS int) AS num_tokens,
           array_to_string(tokens, ' ') AS tokens
    FROM tokenised WHERE len(tokens) > 1"""

VECTORS = f"""{CLASSED},
    words AS (
        SELECT sentiment AS grp, review_id, pos,
               unnest(regexp_extract_all(lower(sentence), '\\w+')) AS word
        FROM exploded),
    vectors AS (
        SELECT grp, review_id, pos,
               cast(('0x' || substr(md5(word), 1, 8))::bigint % 64 AS int) AS dim,
               count(*)::double AS weight
        FROM words GROUP BY ALL),
    lengths AS (
        SELECT review_id, pos, sqrt(sum(weight * weight)) AS length
        FROM vectors GROUP BY review_id, pos)"""
LABELLED = """
    exploded AS (SELECT vec_id AS review_id, 0 AS pos, NULL AS sentence FROM embeddings),
    vectors AS (
        SELECT label AS grp, vec_id AS review_id, 0 AS pos,
               unnest(generate_series(1, len(embedding))) AS dim,
               unnest(embedding::double[]) AS weight
        FROM embeddings),
    lengths AS (
        SELECT vec_id AS review_id, 0 AS pos,
               sqrt(list_sum(list_transform(embedding::double[], lambda x: x * x))) AS length
        FROM embeddings)"""
LONG = f"""
    WITH {VECTORS}
    SELECT grp AS sentiment, review_id, pos, dim, weight FROM vectors"""
ORACLE["q19_hashed_vectors"] = LONG
ORACLE["q39_encoded_vectors"] = LONG
DISTANCE = "round(1 - product::double / 4611686018427387904.0, 6) + 0.0 AS distance"


def distances(vectors: str) -> str:
    """Unit vectors in whole numbers of 1 / 2**31, so that sums are exact and ranked as such."""
    return f"""{vectors},
    units AS (
        SELECT grp, review_id, pos, dim,
               round_even(weight / length * 2147483648, 0)::bigint AS unit
        FROM vectors JOIN lengths USING (review_id, pos) WHERE length > 0),
    sizes AS (
        SELECT grp, count(DISTINCT (review_id, pos)) AS size FROM units GROUP BY grp),
    means AS (
        SELECT grp, dim, (sum(unit) // any_value(size))::bigint AS mean
        FROM units JOIN sizes USING (grp) GROUP BY grp, dim),
    products AS (
        SELECT grp, review_id, pos, sum(unit * mean) AS product
        FROM units JOIN means USING (grp, dim) GROUP BY grp, review_id, pos),
    distances AS (SELECT grp, review_id, pos, {DISTANCE} FROM products),
    best AS (
        SELECT * FROM products
        QUALIFY row_number() OVER (
            PARTITION BY grp ORDER BY product DESC, review_id, pos) = 1),
    centres AS (
        SELECT b.grp, b.review_id, b.pos, e.sentence, {DISTANCE}
        FROM best b JOIN exploded e USING (review_id, pos)),
    centre_units AS (
        SELECT grp, dim, unit AS centre_unit
        FROM units JOIN best c USING (grp, review_id, pos)),
    dots AS (
        SELECT u.grp, u.review_id, u.pos, sum(unit * coalesce(centre_unit, 0)) AS product
        FROM units u LEFT JOIN centre_units cu ON u.grp = cu.grp AND u.dim = cu.dim
        GROUP BY ALL),
    nearest AS (
        SELECT d.grp, d.review_id, d.pos, c.review_id AS centre_review_id,
               c.pos AS centre_pos, c.sentence AS centre_sentence, d.product,
               round(1 - d.product::double / 4611686018427387904.0, 6) + 0.0 AS distance
        FROM dots d JOIN centres c ON d.grp = c.grp
        WHERE d.review_id <> c.review_id OR d.pos <> c.pos)"""


def nearest(vectors: str, group: str, sentence: str = "") -> str:
    return f"""
    WITH {distances(vectors)},
    ranked AS (
        SELECT *, cast(row_number() OVER (
            PARTITION BY grp ORDER BY product DESC, review_id, pos) AS int) AS rank
        FROM nearest)
    SELECT grp AS {group}, review_id, pos, centre_review_id, centre_pos, {sentence}
           distance, rank
    FROM ranked WHERE rank <= 10"""


def grouped(vectors: str, group: str, result: str, sentence: str = "") -> str:
    return f"""
    WITH {distances(vectors)}
    SELECT grp AS {group}, review_id, pos, {sentence} distance FROM {result}"""


ORACLE["q20_mean_distances"] = grouped(VECTORS, "sentiment", "distances")
ORACLE["q21_class_centres"] = grouped(VECTORS, "sentiment", "centres", "sentence,")
ORACLE["q22_nearest_sentences"] = nearest(VECTORS, "sentiment", "centre_sentence,")
ORACLE["q40_label_centres"] = grouped(LABELLED, "label", "centres")
ORACLE["q41_label_nearest"] = nearest(LABELLED, "label")
TOKENISED = f"""{CLASSED},
    tokenised AS (
        SELECT *, regexp_extract_all(lower(sentence), '\\w+') AS tokens FROM trimmed)"""
ORACLE["q23_word2vec_vectors"] = f"""
    WITH {TOKENISED}
    SELECT sentiment, review_id, pos, cast(512 AS int) AS size, true AS is_mean
    FROM tokenised WHERE len(tokens) > 1"""
ORACLE["q24_word2vec_nearest"] = f"""
    WITH {TOKENISED},
    sizes AS (
        SELECT sentiment, count(*) AS n FROM tokenised WHERE len(tokens) > 1
        GROUP BY sentiment)
    SELECT sentiment, cast(rank AS int) AS rank, true AS agrees
    FROM (SELECT sentiment, unnest(generate_series(1, least(10, n - 1))) AS rank FROM sizes)"""

RATIO = """
    SELECT p_brand AS category,
           count(DISTINCT (l_partkey, s_nationkey))::double
               / count(DISTINCT l_partkey) AS ratio
    FROM lineitem JOIN part ON l_partkey = p_partkey
    JOIN supplier ON l_suppkey = s_suppkey
    GROUP BY p_brand"""
RATIO_TEXT = f"""
    SELECT category, printf('%.2f', ratio) AS countries_per_video FROM ({RATIO})"""
ORACLE["q25_countries_per_video"] = f"""
    SELECT category, round(ratio, 6) AS countries_per_video FROM ({RATIO})"""
ORACLE["q26_countries_per_video_text"] = RATIO_TEXT
ORACLE["q36_text_round_trip"] = RATIO_TEXT

SIGHTINGS = """
    SELECT l_partkey AS video_id, l_suppkey AS country,
           l_shipdate::date AS trending_date, l_returnflag AS category,
           trunc(l_quantity)::bigint AS likes, trunc(l_extendedprice)::bigint AS dislikes
    FROM lineitem"""
GROWTH = f"""
    WITH ordered AS (
        SELECT *, row_number() OVER seen AS place,
               lead(likes) OVER seen AS next_likes, lead(dislikes) OVER seen AS next_dislikes
        FROM ({SIGHTINGS})
        WINDOW seen AS (PARTITION BY video_id, country
                        ORDER BY trending_date, category, likes, dislikes))
    SELECT video_id, (next_dislikes - dislikes) - (next_likes - likes) AS growth,
           category, country
    FROM ordered WHERE place = 1 AND next_likes IS NOT NULL"""
ORACLE["q27_growth"] = GROWTH
ORACLE["q28_top_growth"] = f"""
    SELECT * FROM ({GROWTH}) ORDER BY growth DESC, video_id, country LIMIT 10"""
ORACLE["q29_sightings"] = f"""
    SELECT * REPLACE (strftime(trending_date, '%Y-%m-%d') AS trending_date)
    FROM ({SIGHTINGS})"""

GENRES = """
    SELECT p_partkey AS movie_id, unnest(string_split(p_name, ' ')) AS genre FROM part"""
ORACLE["q30_movie_genres"] = GENRES
ORACLE["q31_average_rating_per_genre"] = f"""
    SELECT genre, round(avg(l_quantity), 6) AS average_rating
    FROM ({GENRES}) JOIN lineitem ON movie_id = l_partkey GROUP BY genre"""
TAGS = """
    SELECT tag, owner, count(*) AS n
    FROM (SELECT p_brand AS owner, unnest(string_split(p_name, ' ')) AS tag FROM part)
    WHERE tag <> '' AND NOT regexp_matches(tag, '[^\\x00-\\x7F]')
    GROUP BY tag, owner"""
ORACLE["q32_tag_owners"] = TAGS


def pages(owners_per_row: int) -> str:
    return f"""
    WITH counts AS ({TAGS}),
    placed AS (
        SELECT *, (row_number() OVER (PARTITION BY tag ORDER BY n DESC, owner) - 1)
                  // {owners_per_row} AS page
        FROM counts)
    SELECT tag, page, string_agg(owner || '=' || n || ',', '' ORDER BY n DESC, owner) AS owners
    FROM placed GROUP BY tag, page"""


ORACLE["q33_inverted_list"] = pages(10_000)
ORACLE["q45_inverted_list_pages"] = pages(10)

WHITE_SPACE = " || ".join(
    f"chr({code})"
    for code in [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B)]
    + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)
ORACLE["q34_line_fields"] = f"""
    WITH lines AS (
        SELECT doc_id, cast(i - 1 AS int) AS line_no, line[i] AS value
        FROM (SELECT doc_id, line, unnest(generate_series(1, len(line))) AS i
              FROM (SELECT doc_id, string_split(text, chr(10)) AS line FROM documents))),
    parsed AS (
        SELECT doc_id, line_no, string_split(
            rtrim(trim(value, {WHITE_SPACE}), ','), ',') AS fields
        FROM lines)
    SELECT doc_id, line_no, fields[1] AS video_id, fields[4] AS category,
           fields[12] AS country
    FROM parsed WHERE len(fields) >= 12 AND fields[1] <> 'video_id'"""
ORACLE["q35_rating_lines"] = """
    WITH lines AS (
        SELECT concat_ws(',', o_custkey, o_orderkey,
            CASE o_orderstatus
                WHEN 'O' THEN o_orderpriority
                WHEN 'P' THEN o_totalprice::decimal(18,2) || ','
                ELSE (o_totalprice::decimal(18,2))::varchar END,
            strftime(o_orderdate, '%Y%m%d')) AS value
        FROM orders),
    parsed AS (SELECT string_split(value, ',') AS parts FROM lines)
    SELECT parts[2] AS movie_id, try_cast(parts[3] AS double) AS rating
    FROM parsed WHERE len(parts) = 4 AND try_cast(parts[3] AS double) IS NOT NULL"""
ORACLE["q37_review_file"] = """
    SELECT (n_chars % 50)::varchar AS customer_id, doc_id::varchar AS review_id,
           lang AS product_id,
           CASE source WHEN 'src0' THEN NULL ELSE substr(source, 4)::int END AS star_rating,
           regexp_replace(text, '\\s', ' ', 'g') AS review_body
    FROM documents"""
ORACLE["q38_dates"] = """
    WITH texts AS (
        SELECT o_orderkey,
               CASE o_orderstatus WHEN 'O' THEN '31.' ELSE '' END
                   || strftime(o_orderdate, '%d.%m.%y') AS date_text
        FROM orders)
    SELECT o_orderkey, date_text,
           strftime(try_strptime(date_text, '%d.%m.%y'), '%Y-%m-%d') AS parsed,
           strftime(try_strptime(date_text, '%d.%m.%y'), '%d.%m.%y') AS formatted
    FROM texts"""
ORACLE["q42_video_file"] = f"""
    SELECT video_id::varchar AS video_id, country::varchar AS country,
           strftime(trending_date, '%Y-%m-%d') AS trending_date, category, likes, dislikes
    FROM ({SIGHTINGS} WHERE l_linestatus <> 'O')"""
ORACLE["q43_movie_file"] = f"""
    SELECT movie_id::varchar AS movie_id, genre
    FROM ({GENRES} WHERE p_type NOT IN ('ECONOMY', 'SMALL'))"""
ORACLE["q44_photo_file"] = TAGS
ORACLE["q46_review_layouts"] = ORACLE["q37_review_file"]
ORACLE["q47_video_file_growth"] = """
    WITH read AS (
        SELECT l_partkey::varchar AS video_id,
               CASE WHEN l_linestatus = 'O' THEN 'none' ELSE l_suppkey::varchar END AS country,
               CASE WHEN l_linenumber <> 7 THEN l_shipdate::date END AS trending_date,
               l_returnflag AS category,
               CASE WHEN l_returnflag <> 'R' THEN trunc(l_quantity)::bigint END AS likes,
               trunc(l_extendedprice)::bigint AS dislikes
        FROM lineitem),
    ordered AS (
        SELECT *, row_number() OVER seen AS place, lead(likes) OVER seen AS next_likes,
               lead(dislikes) OVER seen AS next_dislikes, count(*) OVER (
                   PARTITION BY video_id, country) AS times
        FROM read
        WINDOW seen AS (PARTITION BY video_id, country ORDER BY trending_date NULLS LAST,
                        category, likes NULLS FIRST, dislikes))
    SELECT video_id, (next_dislikes - dislikes) - (next_likes - likes) AS growth,
           category, country
    FROM ordered WHERE place = 1 AND times > 1
    ORDER BY growth DESC NULLS LAST, video_id, country LIMIT 10"""
ORACLE["q48_rating_files"] = f"""
    SELECT genre, round(avg(l_quantity), 6) AS average_rating
    FROM ({GENRES} WHERE p_type NOT IN ('ECONOMY', 'SMALL')) JOIN lineitem ON movie_id = l_partkey
    WHERE l_returnflag <> 'R' AND l_linenumber <> 1 GROUP BY genre"""

ORACLE["q49_gzip_members"] = ORACLE["q37_review_file"]
ORACLE["q50_positional_zip"] = """
    WITH by_key AS (
        SELECT o_orderkey, o_orderstatus, row_number() OVER (ORDER BY o_orderkey) - 1 AS position
        FROM orders),
    by_price AS (
        SELECT o_orderkey AS priced_orderkey, round(o_totalprice * 100)::bigint AS cents,
               row_number() OVER (ORDER BY round(o_totalprice * 100) DESC, o_orderkey) - 1
                   AS position
        FROM orders)
    SELECT position, o_orderkey, o_orderstatus, priced_orderkey, cents
    FROM by_key JOIN by_price USING (position)"""
ORACLE["q51_exact_quantiles"] = """
    WITH ordered AS (
        SELECT l_returnflag, round(l_extendedprice * 100)::bigint AS cents,
               row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice) - 1 AS place,
               count(*) OVER (PARTITION BY l_returnflag) AS n
        FROM lineitem),
    wanted AS (
        SELECT DISTINCT l_returnflag, n, fraction, (n - 1) * fraction AS spot
        FROM ordered, (SELECT unnest([0.0, 0.25, 0.5, 0.9, 1.0])::double AS fraction))
    SELECT w.l_returnflag, w.fraction, w.n, a.cents AS lower, b.cents AS upper,
           round(CASE WHEN a.cents = b.cents THEN a.cents::double
                 ELSE a.cents::double + (b.cents - a.cents)::double * (spot - floor(spot)) END, 6)
               AS quantile
    FROM wanted w
    JOIN ordered a ON a.l_returnflag = w.l_returnflag AND a.place = floor(spot)
    JOIN ordered b ON b.l_returnflag = w.l_returnflag AND b.place = ceil(spot)"""
ORACLE["q52_folded_average"] = ORACLE["q31_average_rating_per_genre"]
ORACLE["q53_folded_growth"] = ORACLE["q27_growth"]

ORACLE["q55_bad_videos"] = """
    SELECT CASE WHEN l_linenumber = 7 THEN 'trending_date' ELSE 'likes' END AS reason,
           l_partkey::varchar AS video_id, count(*) AS lines
    FROM lineitem WHERE l_linenumber = 7 OR l_returnflag = 'R' GROUP BY ALL"""
ORACLE["q56_bad_ratings"] = """
    SELECT CASE WHEN l_linenumber = 1 THEN 'fields' ELSE 'rating' END AS reason,
           l_partkey::varchar AS movie_id, count(*) AS lines,
           (SELECT count(*) FROM lineitem) AS all_lines
    FROM lineitem WHERE l_linenumber = 1 OR l_returnflag = 'R' GROUP BY ALL"""
ORACLE["q57_growth_by_arrival"] = """
    WITH ordered AS (
        SELECT l_partkey::varchar AS video_id, l_suppkey::varchar AS country,
               l_returnflag AS category, trunc(l_quantity)::bigint AS likes,
               trunc(l_extendedprice)::bigint AS dislikes,
               row_number() OVER seen AS place, lead(trunc(l_quantity)::bigint) OVER seen AS next_likes,
               lead(trunc(l_extendedprice)::bigint) OVER seen AS next_dislikes,
               count(*) OVER (PARTITION BY l_partkey, l_suppkey) AS times
        FROM lineitem WHERE l_linestatus <> 'O'
        WINDOW seen AS (PARTITION BY l_partkey, l_suppkey ORDER BY l_orderkey, l_linenumber))
    SELECT video_id, (next_dislikes - dislikes) - (next_likes - likes) AS growth,
           category, country
    FROM ordered WHERE place = 1 AND times > 1"""
ORACLE["q58_ordered_files"] = f"""
    SELECT row_number() OVER (ORDER BY growth DESC, video_id, country) - 1 AS position,
           concat_ws(chr(9), video_id, growth, category, country) AS value,
           count(*) OVER () AS all_rows
    FROM ({GROWTH})"""
ORACLE["q59_pruned_nearest"] = ORACLE["q41_label_nearest"]
