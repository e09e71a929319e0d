"""One query per operator: (spark, folder of the tables) to a DataFrame over the whole table."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from schoolatlas.llm import (
    decontaminate,
    hard_negatives,
    html_text,
    language,
    line_rules,
    mixing,
    ngram_join,
    secrets,
    sentence_pieces,
    sharding,
    spelling_variants,
    suffix_dedup,
    token_counts,
)
from schoolatlas.llm.common import store, table


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learnt from the documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs.select("doc_id", "text"), language.learn(docs))
    return found.select(
        "doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "bits_per_byte"
    )


def op2_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base quality counts and the verdict by cross-document line frequency."""
    rated = line_rules.rate(table(spark, sf_dir, "documents"))
    return rated.select("doc_id", *line_rules.BASE, "base_failed", "kept", "n_removed_words")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document the mix of the sources takes."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of every document under n-gram Jaccard links."""
    resolved = ngram_join.resolve(table(spark, sf_dir, "documents"))
    return resolved.select("doc_id", "n_shingles", "component_id")


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page, without the templates of its host."""
    return html_text.extract(table(spark, sf_dir, "pages"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, with the weak parts that complete each other."""
    return secrets.report(table(spark, sf_dir, "documents"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the byte strings that documents of smaller id hold."""
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard and place after the external shuffle."""
    text, doc_id = F.col("text"), F.col("doc_id")
    return sharding.shuffle(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id",
        sharding.size_of(text).alias("size"),
        sharding.checksum(text).alias("text_crc32"),
        F.lit("key").alias("law"),
        "shard",
        "slot",
        sharding.shard_of(doc_id, sharding.SHARDS + 1).alias("grown_shard"),
    )


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, found by scanning flat token files made of the documents."""
    docs = table(spark, sf_dir, "documents")
    counted = token_counts.count_tokens(store(token_counts.token_blocks(docs)))
    return token_counts.manifest(docs).join(counted, ["file", "ordinal"], "full").select(
        "doc_id", "file", "ordinal", "start", "n_tokens", "complete"
    )


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark items that stand in documents."""
    found = decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_words", "n_matched", "similarity", "start")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of other labels that score close below every anchor's positives."""
    label, vec_id = F.col("label").cast("long"), F.col("vec_id")
    shifted = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), shifted)


def op12_sentence_pieces(spark: SparkSession, sf_dir: str, model: str | None = None) -> DataFrame:
    """Digests of every document's ids under a SentencePiece model and of the text decoded from them."""
    if model is None:
        import public_tokenizers

        model = public_tokenizers.path("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentence_pieces.encode(docs, Path(model).read_bytes()).select(
        "doc_id",
        (F.octet_length("tokens") / 4).cast("long").alias("n_tokens"),
        F.sha2("tokens", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frequent word with its near words' number, its form and the end of its chain of forms."""
    words = spelling_variants.count_words(table(spark, sf_dir, "documents"))
    return spelling_variants.group_variants(words).select("word", "form", "root", "n", "n_near", "form_n")


QUERIES = {
    "op1_language": op1_language,
    "op2_line_rules": op2_line_rules,
    "op3_mixing": op3_mixing,
    "op4_ngram_join": op4_ngram_join,
    "op5_html_text": op5_html_text,
    "op6_secrets": op6_secrets,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_sharding": op8_sharding,
    "op9_token_counts": op9_token_counts,
    "op10_decontaminate": op10_decontaminate,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_sentence_pieces": op12_sentence_pieces,
    "op13_spelling_variants": op13_spelling_variants,
}

#: DuckDB statements for the queries that SQL can express.
SQL: dict[str, str] = {}

SQL["op2_line_rules"] = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce('=' || source, '') AS host, text,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents),
lines AS (
    SELECT r, host, text, i, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS words
    FROM (SELECT r, host, text, unnest(string_split(text, chr(10))) AS line,
            generate_subscripts(string_split(text, chr(10)), 1) AS i FROM docs)),
worded AS (
    SELECT *, len(words) AS n, translate(array_to_string(words, ' '),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
    FROM lines WHERE len(words) > 0),
dups AS (SELECT r, sum(c - 1) AS n FROM (SELECT r, line, count(*) AS c FROM worded GROUP BY r, line) GROUP BY r),
windows AS (
    SELECT r, i, array_to_string(words[i : i + 7], ' ') AS w
    FROM (SELECT r, words, unnest(range(1, len(words) - 6)) AS i FROM docs)),
covered AS (
    SELECT r, count(DISTINCT i + o) AS n
    FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS c FROM windows), range(8) AS t(o)
    WHERE c > 1 GROUP BY r),
own AS (SELECT host, text, norm, sum(n) AS n FROM worded GROUP BY r, host, text, norm),
lined AS (SELECT host, text, norm, max(n) AS n FROM own GROUP BY host, text, norm),
hosts AS (SELECT host, count(DISTINCT coalesce('=' || text, '')) AS d FROM docs GROUP BY host),
frequent AS (
    SELECT host, norm FROM lined JOIN hosts USING (host) GROUP BY host, norm, d
    HAVING count(*) > 8 AND count(*) > least(d * 0.01::DOUBLE, 50)),
removed AS (SELECT host, text, sum(n) AS n FROM lined JOIN frequent USING (host, norm) GROUP BY host, text),
rated AS (
    SELECT doc_id, len(words) AS n_words, coalesce(length(array_to_string(words, '')), 0) AS word_chars,
        coalesce(length(docs.text) - length(regexp_replace(docs.text, '[#*$%&|<>]', '', 'g')), 0) AS n_symbols,
        coalesce(dups.n, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words, coalesce(removed.n, 0) AS gone
    FROM docs LEFT JOIN dups USING (r) LEFT JOIN covered USING (r)
        LEFT JOIN removed ON docs.host = removed.host AND docs.text = removed.text),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM rated)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
    n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
    NOT base_failed AND n_words - gone >= n_words * 0.5 AS kept, gone::BIGINT AS n_removed_words
FROM judged
"""

SQL["op3_mixing"] = r"""
WITH docs AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size, coalesce(text, '') AS t
    FROM documents),
keyed AS (
    SELECT doc_id, source, size, t,
        -ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '/' || md5(t)), 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656.0::DOUBLE)
        / (1.0::DOUBLE / (1.0::DOUBLE + 20 * ((length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::DOUBLE / greatest(length(t), 1)))) AS k
    FROM docs),
sizes AS (SELECT source, sum(size)::DOUBLE AS s FROM docs GROUP BY source),
weighed AS (
    SELECT source, s, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
        WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w
    FROM sizes),
ranked AS (
    SELECT *, coalesce(sum(3 * s) OVER before, 0) AS capped, sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS open,
        sum(s) OVER () AS total
    FROM weighed WINDOW before AS (ORDER BY 3 * s / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
plan AS (
    SELECT source, s, least(3 * s, max((total - capped) / open) OVER () * w) AS target FROM ranked),
budgets AS (
    SELECT source, s, target, CASE WHEN s > 0 THEN least(floor(target / s), 3) ELSE 0 END AS epochs FROM plan),
placed AS (
    SELECT keyed.doc_id, size, s, target, epochs, round(target - epochs * s) - coalesce(sum(size) OVER (
        PARTITION BY keyed.source ORDER BY k, keyed.doc_id, t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room
    FROM keyed JOIN budgets ON keyed.source IS NOT DISTINCT FROM budgets.source)
SELECT doc_id, size::BIGINT AS size, s::BIGINT AS source_size, target,
    (epochs * size + greatest(0, least(size, room)))::BIGINT AS taken
FROM placed
"""

_PATTERNS = ", ".join(
    "({}, '{}', {})".format(secrets.PLACE[kind], pattern.replace("'", "''"), group)
    for kind, pattern, group in (
        ("assign", secrets.ASSIGN, 2),
        ("access", secrets.ACCESS, 0),
        ("hex", secrets.HEX, 0),
        ("identifier", secrets.IDENTIFIER, 0),
        ("secret", secrets.TOKEN, 0),
        ("endpoint", secrets.ENDPOINT, 0),
    )
)
_KINDS = ", ".join(f"'{kind}'" for kind in secrets.KINDS)
SQL["op6_secrets"] = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
patterns(kind, p, g) AS (VALUES {_PATTERNS}),
found AS (
    SELECT r, kind, unnest(regexp_extract_all(text, p, 0)) AS m, unnest(regexp_extract_all(text, p, g)) AS value,
        unnest(regexp_split_to_array(text, p)[: len(regexp_extract_all(text, p, 0))]) AS gap,
        unnest(range(0, len(regexp_extract_all(text, p, 0)))) AS i
    FROM docs, patterns),
placed AS (
    SELECT r, kind, value, length(m) AS n, sum(length(gap) + length(m)) OVER (PARTITION BY r, kind ORDER BY i) AS stop FROM found),
kinds AS (
    SELECT r, stop - n AS start, stop, CASE
        WHEN kind = 0 AND length(value) < 12 THEN CASE WHEN length(value) >= 4 THEN 4 END
        WHEN kind = 4 AND NOT (regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Z]') AND regexp_matches(value, '[a-z]')) THEN NULL
        ELSE kind END AS kind
    FROM placed),
parts AS (
    SELECT DISTINCT r, start, stop, kind, CASE WHEN kind IN (1, 3) THEN 'identifier' WHEN kind = 5 THEN 'endpoint' ELSE 'secret' END AS role
    FROM kinds WHERE kind IS NOT NULL),
linked AS (
    SELECT * FROM parts w WHERE kind >= 3
        AND EXISTS (SELECT 1 FROM parts o WHERE o.r = w.r AND (o.stop <= w.start OR o.start >= w.stop)
            AND o.stop >= w.start - {secrets.REACH} AND o.start <= w.stop + {secrets.REACH}
            AND (w.role = 'secret') <> (o.role = 'secret'))
        AND NOT EXISTS (SELECT 1 FROM parts o WHERE w.kind = 4 AND o.r = w.r AND o.kind < 3 AND o.stop > w.start AND o.start < w.stop)),
spans AS (
    SELECT r, kind, start, stop, ([{_KINDS}])[kind + 1] || ':' || start::BIGINT || ':' || stop::BIGINT AS span
    FROM (SELECT r, kind, start, stop FROM parts WHERE kind < 3 UNION ALL SELECT r, kind, start, stop FROM linked)),
joined AS (
    SELECT r, count(*) FILTER (kind = 0) AS a, count(*) FILTER (kind = 1) AS b, count(*) FILTER (kind = 2) AS c,
        coalesce(string_agg(span, ',' ORDER BY start, kind, stop) FILTER (kind < 3), '') AS base,
        string_agg(span, ',' ORDER BY start, kind, stop) AS spans
    FROM spans GROUP BY r)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(b, 0) AS n_access, coalesce(c, 0) AS n_hex,
    sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN joined USING (r)
"""

SQL["op9_token_counts"] = r"""
WITH docs AS (
    SELECT doc_id, (coalesce(doc_id, 0) % (SELECT greatest(1, ceil(count(*) / 4096.0))::BIGINT FROM documents))::BIGINT AS file,
        len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS n
    FROM documents)
SELECT doc_id, file, row_number() OVER w - 1 AS ordinal,
    (coalesce(sum(n + 1) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS start,
    n AS n_tokens, true AS complete
FROM docs WINDOW w AS (PARTITION BY file ORDER BY doc_id NULLS FIRST, n)
"""

SQL["op10_decontaminate"] = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, words FROM (
        SELECT DISTINCT doc_id, text, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS words FROM documents)),
items AS (
    SELECT DISTINCT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS words FROM benchmark),
masks(mask, p) AS (VALUES (0, [0, 1, 2, 4, 5, 6]), (1, [0, 1, 3, 5, 6]), (2, [0, 2, 3, 4, 6]), (3, [0, 1, 4, 5, 6])),
doc_seeds AS (
    SELECT r, pos, mask, array_to_string(list_transform(p, lambda x: words[pos + x + 1]), ' ') AS seed
    FROM (SELECT r, words, unnest(range(0, len(words) - 6)) AS pos FROM docs), masks),
item_seeds AS (
    SELECT item_id, pos, mask, p, n, array_to_string(list_transform(p, lambda x: words[pos + x + 1]), ' ') AS seed
    FROM (SELECT item_id, words, len(words) AS n, unnest(range(0, len(words) - 6)) AS pos FROM items), masks),
hits AS (
    SELECT DISTINCT r, item_id, n, d.pos - i.pos AS diagonal, unnest(list_transform(p, lambda x: x + i.pos)) AS place
    FROM doc_seeds d JOIN item_seeds i USING (mask, seed)),
banded AS (
    SELECT *, unnest([floor(diagonal / 8.0)::BIGINT * 2, floor((diagonal + 4) / 8.0)::BIGINT * 2 + 1]) AS band FROM hits),
candidates AS (
    SELECT r, item_id, diagonals, max(whole) AS whole FROM (
        SELECT r, item_id, n, band, list_sort(list(DISTINCT diagonal)) AS diagonals, count(DISTINCT place) >= n * 0.4::DOUBLE AS whole
        FROM banded GROUP BY r, item_id, n, band)
    WHERE whole OR n >= 14 GROUP BY r, item_id, diagonals),
placed AS (
    SELECT r, item_id, diagonals, whole, unnest(diagonals) AS d, docs.doc_id, docs.words AS dw, items.words AS iw
    FROM candidates JOIN docs USING (r) JOIN items USING (item_id)),
standing AS (
    SELECT r, doc_id, item_id, diagonals, whole, len(iw) AS n, place,
        bool_or(place + d >= 0 AND coalesce(dw[place + d + 1] = iw[place + 1], false)) AS stands
    FROM (SELECT *, unnest(range(0, len(iw))) AS place FROM placed)
    GROUP BY r, doc_id, item_id, diagonals, whole, n, place),
summed AS (
    SELECT *, sum(stands::INTEGER) OVER (PARTITION BY r, item_id, diagonals ORDER BY place) AS c FROM standing),
parts AS (
    SELECT DISTINCT a.r, a.item_id, a.diagonals, true AS part
    FROM summed a JOIN summed b ON a.r = b.r AND a.item_id IS NOT DISTINCT FROM b.item_id AND a.diagonals = b.diagonals
    WHERE a.stands AND b.stands AND b.place - a.place >= 13 AND 5 * (b.c - a.c + 1) >= 4 * (b.place - a.place + 1)),
judged AS (
    SELECT r, doc_id, item_id, diagonals, n, whole AND matched::DOUBLE / n >= 0.8::DOUBLE AS whole, matched
    FROM (SELECT r, doc_id, item_id, diagonals, whole, n, count(*) FILTER (stands) AS matched FROM standing GROUP BY ALL)),
best AS (
    SELECT j.*, row_number() OVER (PARTITION BY j.r, j.item_id ORDER BY j.whole DESC, matched DESC, j.diagonals[1]) AS k
    FROM judged j LEFT JOIN parts p ON j.r = p.r AND j.item_id IS NOT DISTINCT FROM p.item_id AND j.diagonals = p.diagonals
    WHERE j.whole OR p.part)
SELECT doc_id, item_id, n::INTEGER AS n_words, matched::INTEGER AS n_matched, matched::DOUBLE / n AS similarity,
    diagonals[1]::INTEGER AS start
FROM best WHERE k = 1
"""

SQL["op11_hard_negatives"] = r"""
WITH numbered AS (
    SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(greatest(least(x::DOUBLE * 256, 16777216), -16777216))::HUGEINT) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND coalesce(list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))), true)),
scored AS (
    SELECT a.r, a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS other_id, b.r AS other,
        coalesce(list_sum(list_transform(list_zip(a.v, b.v), lambda p: coalesce(p[1] * p[2], 0))), 0)::BIGINT AS score
    FROM numbered a JOIN numbered b ON a.label <> b.label OR a.vec_id <> b.vec_id
    WHERE a.vec_id % 100 = 0),
positives AS (
    SELECT r, anchor_id, other_id, score, row_number() OVER (PARTITION BY r ORDER BY score DESC, other_id) AS place
    FROM scored WHERE same QUALIFY place <= 5),
negatives AS (
    SELECT p.r, p.anchor_id, p.place, p.other_id AS positive_id, p.score AS positive_score, s.other_id AS negative_id, s.score AS negative_score,
        row_number() OVER (PARTITION BY p.r, p.place ORDER BY s.score DESC, s.other_id) AS rank
    FROM positives p JOIN scored s ON s.r = p.r AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 5
"""

SQL["op13_spelling_variants"] = r"""
WITH RECURSIVE table_steps(b, c, k) AS (
    SELECT range::BIGINT, range::BIGINT, 0 FROM range(256)
    UNION ALL
    SELECT b, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, k + 1 FROM table_steps WHERE k < 8),
crc(t) AS (SELECT list(c ORDER BY b) FROM table_steps WHERE k = 8),
runs AS (
    SELECT doc_id, run, count(*) AS n FROM (
        SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents)
    WHERE length(run) >= 5 GROUP BY ALL),
seeded AS (
    SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(
        range(0, octet_length(encode(s))), lambda i: ('0x' || substr(hex(encode(s)), 2 * i + 1, 2))::BIGINT)),
        lambda h, x: xor(h >> 8, t[(xor(h, x) & 255) + 1]))) AS h
    FROM (SELECT run, n, coalesce(doc_id::VARCHAR, '') || ':' || run AS s FROM runs), crc),
words AS (
    SELECT word, sum(n)::BIGINT AS n FROM (
        SELECT n, CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
        FROM seeded)
    WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cut AS (
    SELECT word, n, i, substr(word, 1, i - 1) AS head, substr(word, i + 1) AS tail
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
    SELECT a.word, b.word AS other, b.n FROM cut a JOIN cut b ON a.i = b.i AND a.head = b.head AND a.tail = b.tail AND a.word <> b.word
    UNION
    SELECT c.word, w.word, w.n FROM cut c JOIN words w ON w.word = c.head || c.tail
    UNION
    SELECT w.word, c.word, c.n FROM cut c JOIN words w ON w.word = c.head || c.tail),
best AS (
    SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, encode(other)) AS form, max(n) AS form_n FROM near GROUP BY word),
formed AS (
    SELECT word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 2 * w.n THEN form END AS form,
        CASE WHEN form_n >= 2 * w.n THEN form_n END AS form_n
    FROM words w LEFT JOIN best USING (word)),
chains(word, last) AS (
    SELECT word, word FROM formed
    UNION ALL
    SELECT c.word, f.form FROM chains c JOIN formed f ON f.word = c.last WHERE f.form IS NOT NULL)
SELECT word, n, n_near, form, form_n, last AS root
FROM formed JOIN (SELECT c.word, c.last FROM chains c JOIN formed f ON f.word = c.last WHERE f.form IS NULL) USING (word)
"""
