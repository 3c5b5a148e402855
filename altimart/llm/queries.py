"""One query per operator over the driver's tables, and SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from altimart.llm import (
    bpe,
    decontaminate,
    exact_dedup,
    langid,
    lm,
    ngram_join,
    quality,
    resampling,
    secret_scan,
    sharding,
    spelling,
    substring,
    toxicity,
)
from altimart.llm.common import remainder, table

RANKS = "byte_bpe_50k.tiktoken"


def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    done = substring.repeated_passages(table(spark, folder, "documents"))
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["length"])
    return done.select(
        "doc_id",
        "n_words",
        gone.alias("n_removed"),
        F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"),
    )


def op6_sharding(spark: SparkSession, folder: str) -> DataFrame:
    shards = sharding.byte_shards(table(spark, folder, "documents"), 16)
    return shards.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows = exact_dedup.exact_duplicates(table(spark, folder, "documents"))
    return rows.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op8_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    docs = table(spark, folder, "documents").select("doc_id", "text")
    done = bpe.round_trip(docs, ranks, pattern)
    words = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(words.cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op1_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.alike(table(spark, folder, "documents"), width=4, percent=85)


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contained_items(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )


def op3_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    scored = lm.text_scores(table(spark, folder, "documents"), remainder("doc_id", 5) != 1)
    return scored.select(
        "doc_id",
        (~F.col("learnt")).alias("held_out"),
        "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte",
    )


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").where(remainder("doc_id", 3) != 1)
    scored = quality.score(docs, quality.train(docs, labels))
    return scored.select(
        "doc_id",
        (remainder("doc_id", 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


# Plain insults, which tell open from veiled abuse among the labelled rows.
INSULTS = (
    "clown", "disgusting", "idiot", "loser", "moron", "pathetic", "scum", "stupid", "trash",
    "worthless",
)
CATEGORIES = ("poor", "open", "veiled", "toxic")


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Poor text, abuse in plain insults, abuse in other words, and toxicity as a whole."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").where(remainder("doc_id", 3) != 1)
    labels = labels.select("doc_id", (1 - F.col("quality")).alias("poor"), "toxic")
    plain = F.lower("__text").rlike(rf"\b({'|'.join(INSULTS)})\b")
    toxic = F.col("toxic") == 1
    derived = {"open": toxic & plain, "veiled": toxic & ~plain}
    chain = toxicity.train(docs, labels, CATEGORIES, derived=derived)
    scored = toxicity.score(docs, chain, CATEGORIES)
    return scored.select(
        "doc_id",
        (remainder("doc_id", 3) == 1).alias("held_out"),
        *[f"p_{c}" for c in CATEGORIES],
        F.col("p_toxic").alias("score"),
        (F.col("p_toxic") >= 0.5).cast("int").alias("predicted"),
    )


def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = langid.train(docs, remainder("doc_id", 3) != 1)
    found = langid.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


def op11_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    done = secret_scan.secret_spans(table(spark, folder, "documents").select("doc_id", "text"))
    of = lambda *kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    return done.select(
        "doc_id",
        *[F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(secret_scan.joined(of("assign", "access", "hex")).cast("binary"), 256).alias("base_sha256"),
        secret_scan.joined(F.col("spans")).alias("spans"),
    )


def op12_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents"), every=31)


def op13_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resampling.resampled(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


QUERIES = {
    "op1_ngram_join": op1_ngram_join,
    "op2_decontamination": op2_decontamination,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_quality": op4_quality,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_sharding": op6_sharding,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_bpe": op8_bpe,
    "op9_toxicity": op9_toxicity,
    "op10_language_id": op10_language_id,
    "op11_secret_scan": op11_secret_scan,
    "op12_spelling": op12_spelling,
    "op13_resampling": op13_resampling,
}

SQL = {
    "op1_ngram_join": r"""
        with recursive words as (
            select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents
        ),
        shingles as (
            select distinct doc_id, md5(array_to_string(w[i:i + 3], ' ')) as s
            from (select doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) as i from words where len(w) > 0)
        ),
        sizes as (select doc_id, count(*) as n from shingles group by 1),
        shared as (
            select a.doc_id as a, b.doc_id as b, count(*) as n
            from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id group by 1, 2
        ),
        links as (
            select a, b from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b
            where 100 * shared.n >= 85 * (x.n + y.n - shared.n)
        ),
        reach(doc_id, other) as (
            select doc_id, doc_id from documents
            union
            select reach.doc_id, b from reach join links on a = other
        )
        select doc_id, coalesce(any_value(n), 0) as n_shingles, min(other) as component_id
        from reach left join sizes using (doc_id) group by doc_id
    """,
    "op5_substring_dedup": r"""
        with texts as (
            select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
        ),
        windows as (
            select doc_id, i, md5(array_to_string(w[i:i + 12], ' ')) as run
            from (select doc_id, w, unnest(range(1, len(w) - 11)) as i from texts)
        ),
        judged as (select doc_id, i, min(doc_id) over (partition by run) < doc_id as gone from windows),
        gone as (
            select distinct doc_id, i + k as i
            from (select doc_id, i from judged where gone), range(13) r(k)
        ),
        words as (select doc_id, unnest(range(1, len(w) + 1)) as i, unnest(w) as word from texts),
        kept as (
            select doc_id, count(*) as n_kept, string_agg(word, ' ' order by i) as kept
            from words anti join gone using (doc_id, i) group by doc_id
        )
        select doc_id, len(w) as n_words, len(w) - coalesce(n_kept, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256
        from texts left join kept using (doc_id)
    """,
    "op2_decontamination": r"""
        with words as (
            select doc_id as id, 'd' as kind, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') as w from documents
            union all
            select item_id, 'i', regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') from benchmark
        ),
        widths as (select id, least(len(w), 5) as k from words where kind = 'i' and len(w) > 0),
        shingles as (
            select distinct id, kind, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) as s
            from words join widths using (id) where kind = 'i'
            union all
            select distinct id, kind, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) as s
            from words, (select distinct k from widths) where kind = 'd'
        ),
        sizes as (select id, count(*) as q from shingles where kind = 'i' group by id),
        shared as (
            select d.id as doc_id, i.id as item_id, count(*) as n
            from shingles d join shingles i on d.s = i.s and d.k = i.k and d.kind = 'd' and i.kind = 'i'
            group by 1, 2
        )
        select doc_id, item_id, q as n_item_shingles, n as n_shared, n / q as containment
        from shared join sizes on id = item_id
        where 100 * n >= 80 * q
    """,
    "op6_sharding": """
        with steps as (  -- crc32 of each byte value, by eight shifts
            select list(list_reduce(list_prepend(b, range(8)),
                        lambda c, i: if(c & 1 = 1, xor(c >> 1, 3988292384), c >> 1)) order by b) as step
            from range(256) t(b)
        ),
        bytes as (
            select doc_id, hex(encode(coalesce(text, ''))) as h from documents
        ),
        sized as (
            select doc_id, cast(len(h) // 2 + 1 as bigint) as size,
                   xor(4294967295, list_reduce(list_prepend(cast(4294967295 as bigint),
                       list_transform(range(len(h) // 2), lambda i: cast('0x' || h[2 * i + 1:2 * i + 2] as bigint))),
                       lambda c, b: xor(c >> 8, step[xor(c, b) % 256 + 1]))) as text_crc32,
                   row_number() over (order by doc_id) as place
            from bytes, steps
        ),
        summed as (
            select doc_id, size, text_crc32, coalesce(sum(size) over (order by place rows between unbounded preceding and 1 preceding), 0) as first,
                   sum(size) over () as total
            from sized
        ),
        cut as (select *, cast(first * 16 // total as integer) as shard from summed)
        select doc_id, size, text_crc32, 'bytes' as law, shard,
               row_number() over (partition by shard order by doc_id) - 1 as slot,
               cast(null as integer) as grown_shard
        from cut
    """,
    "op7_exact_dedup": r"""
        with bare as (
            select doc_id, length(coalesce(text, '')) as long_,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as bare
            from documents
        )
        select doc_id,
               first_value(doc_id) over (partition by bare order by long_ desc, doc_id) as keep_id,
               count(*) over (partition by bare) as group_size,
               row_number() over (partition by bare order by long_ desc, doc_id) = 1 as kept,
               sha256(bare) as text_sha256
        from bare
    """,
    "op11_secret_scan": r"""
        with texts as (
            select row_number() over () as r, doc_id, coalesce(text, '') as t from documents
        ),
        rules(place, kind, pattern, least) as (values
            (0, 'assign', '(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 12),
            (1, 'access', '(AKIA[A-Z0-9]+)', 18),
            (2, 'hex', '([0-9a-f]+)', 16),
            (3, 'forge', '(gh[pousr]_[A-Za-z0-9]{20,})', 0),
            (4, 'chat', '(xox[abprs]-[A-Za-z0-9-]{10,})', 0),
            (5, 'payment', '([rs]k_(?:live|test)_[A-Za-z0-9]{16,})', 0),
            (6, 'map', '(AIza[A-Za-z0-9_-]{30,})', 0),
            (7, 'web', '(eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+)', 0),
            (8, 'pem', '(-----BEGIN [A-Z ]*PRIVATE KEY-----)', 0),
            (9, 'mail', '([a-z]{2,12}://[A-Za-z0-9._-]+:[^\x20\x09-\x0D/@:]{6,}@[A-Za-z0-9.-]+)', 0)
        ),
        found as (
            select r, place, kind, least, unnest(range(1, len(m) + 1)) as i, unnest(m) as m, unnest(g) as g,
                   unnest(gaps[1:len(m)]) as gap
            from (
                select r, place, kind, least, regexp_extract_all(t, pattern, 0) as m, regexp_extract_all(t, pattern, 1) as g,
                       regexp_split_to_array(t, pattern) as gaps
                from texts, rules
            )
        ),
        placed as (
            select *, sum(length(gap) + length(m)) over (partition by r, place order by i) as stop from found
        ),
        spans as (
            select r, place, kind, cast(stop - length(m) as bigint) as start, kind || ':' || cast(stop - length(m) as bigint) || ':' || cast(stop as bigint) as span
            from placed where length(g) >= least
        ),
        listed as (
            select r, count(*) filter (where place = 0) as n_assign, count(*) filter (where place = 1) as n_access,
                   count(*) filter (where place = 2) as n_hex,
                   string_agg(span, ',' order by start, place) filter (where place < 3) as base,
                   string_agg(span, ',' order by start, place) as spans
            from spans group by r
        )
        select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
               sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
        from texts left join listed using (r)
    """,
    "op12_spelling": r"""
        with recursive steps as (  -- crc32 of each byte value, by eight shifts
            select list(list_reduce(list_prepend(b, range(8)),
                        lambda c, i: if(c & 1 = 1, xor(c >> 1, 3988292384), c >> 1)) order by b) as step
            from range(256) t(b)
        ),
        runs as (
            select doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run
            from documents
        ),
        counted as (
            select run, count(*) as times, hex(encode(coalesce(cast(doc_id as varchar), '') || ':' || run)) as h
            from runs where length(run) >= 7 group by doc_id, run
        ),
        hashed as (
            select run, times, xor(4294967295, list_reduce(list_prepend(cast(4294967295 as bigint),
                       list_transform(range(len(h) // 2), lambda i: cast('0x' || h[2 * i + 1:2 * i + 2] as bigint))),
                       lambda c, b: xor(c >> 8, step[xor(c, b) % 256 + 1]))) as h
            from counted, steps
        ),
        vocabulary as (
            select if(h % 31 = 0, run[1:h % length(run)] || run[h % length(run) + 2:], run) as word, cast(sum(times) as bigint) as n
            from hashed group by 1 having length(word) >= 7 and sum(times) >= 2
        ),
        places as (select word, unnest(range(length(word))) as p from vocabulary),
        shapes as (select word, word[1:p] || '*' || word[p + 2:] as star, word[1:p] || word[p + 2:] as less from places),
        pairs as (
            select a.word, b.word as other from shapes a join shapes b on a.star = b.star and a.word <> b.word
            union
            select word, less from shapes where less in (select word from vocabulary)
            union
            select less, word from shapes where less in (select word from vocabulary)
        ),
        near as (
            select p.word, count(*) as n_near, arg_min(v.word, (-v.n, v.word)) as best, max(v.n) as best_n
            from pairs p join vocabulary v on v.word = p.other group by p.word
        ),
        forms as (
            select v.word, v.n, coalesce(n_near, 0) as n_near, if(best_n >= 10 * v.n, best, null) as form,
                   if(best_n >= 10 * v.n, best_n, null) as form_n
            from vocabulary v left join near using (word)
        ),
        chain(word, now) as (
            select word, word from forms
            union
            select chain.word, form from chain join forms on now = forms.word where form is not null
        ),
        lasts as (
            select chain.word, now as root from chain join forms on now = forms.word where forms.form is null
        )
        select word, form, root, n, n_near, form_n from forms join lasts using (word)
    """,
    "op13_resampling": r"""
        with steps as (  -- crc32 of each byte value, by eight shifts
            select list(list_reduce(list_prepend(b, range(8)),
                        lambda c, i: if(c & 1 = 1, xor(c >> 1, 3988292384), c >> 1)) order by b) as step
            from range(256) t(b)
        ),
        words as (
            select kind, id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as word
            from (select 'd' as kind, doc_id as id, text from documents union all select 'b', item_id, text from benchmark)
        ),
        counted as (select kind, id, word, count(*) as n from words group by all),
        hexed as (select word, hex(encode(word)) as h from (select distinct word from counted)),
        hashed as (
            select word, xor(4294967295, list_reduce(list_prepend(cast(4294967295 as bigint),
                       list_transform(range(len(h) // 2), lambda i: cast('0x' || h[2 * i + 1:2 * i + 2] as bigint))),
                       lambda c, b: xor(c >> 8, step[xor(c, b) % 256 + 1]))) % 10000 as bucket
            from hexed, steps
        ),
        sums as (
            select bucket, coalesce(sum(n) filter (where kind = 'd'), 0) as s, coalesce(sum(n) filter (where kind = 'b'), 0) as t
            from counted join hashed using (word) group by bucket
        ),
        gains as (
            select bucket, cast(floor(1000 * ln((t + 1)::double * (sum(s) over () + 10000)::double
                       / ((s + 1)::double * (sum(t) over () + 10000)::double))) as bigint) as gain
            from sums
        ),
        weighed as (
            select id, sum(n) as n_features, sum(n * gain) as weight
            from counted join hashed using (word) join gains using (bucket) where kind = 'd' group by id
        ),
        scored as (
            select doc_id, cast(coalesce(n_features, 0) as bigint) as n_features, cast(coalesce(weight, 0) as bigint) as weight,
                   cast(coalesce(weight, 0) + floor(-1000 * ln(-ln((cast('0x' || sha256('2024:' || doc_id)[1:8] as bigint) + 0.5::double) / 4294967296::double))) as bigint) as score
            from documents left join weighed on id = doc_id
        ),
        ranked as (
            select doc_id, row_number() over (order by score desc, doc_id) as place, count(*) over () as n
            from scored where n_features >= 20
        )
        select doc_id, n_features, weight, score, if(place <= 10 * n // 100, place, null) as rank
        from scored left join ranked using (doc_id)
    """,
}
