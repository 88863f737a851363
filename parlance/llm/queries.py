"""The queries of the nine training-data problems over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.functions.text import contents, strip
from parlance.session import lasting_folder, table

from . import components, confusables, defects, formatting, leaks, near, packing, sampling


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return confusables.kinds_found(table(spark, sf_dir, "documents"))


def p9_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of p9_found whose kind a pattern can tell: all but look-alikes."""
    return p9_found(spark, sf_dir).filter("kind <> 'lookalike'")


def p9_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text in its one form."""
    return confusables.normalized(table(spark, sf_dir, "documents")).select("doc_id", F.col("clean").alias("text"), F.array_join("kinds", ",").alias("kinds"))


def p9_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return confusables.groups(table(spark, sf_dir, "documents"))


#: Problems 3 and 5 in this project: three words, half of all shingles shared. A pair at the threshold itself shares a
#: band with a chance of 98.4 %, one of 0.55 with 99.8 %, one of 0.6 with 99.99 %.
NEAR_3 = near.Params(width=3, threshold=0.5, rows=4, bands=64, kind="hyper")
NEAR_5 = near.Params(width=3, threshold=0.5, rows=4, bands=64, kind="low")


def _texts(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name == "manifest":
        return table(spark, sf_dir, name).select(F.col("row_id").alias("id"), F.col("content").alias("text"))
    return table(spark, sf_dir, name).select(F.col("entry_id").alias("id"), contents(F.col("messages")).alias("text"), "split", "source_id")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = [near.row_pairs(near.near(_texts(spark, sf_dir, t).select("id", "text"), NEAR_3)).select(F.lit(t).alias("table_name"), "id_a", "id_b") for t in ("stage1_entry", "manifest")]
    return out[0].unionByName(out[1])


def p3_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row that is nearly the same as others: its class of copies, and the group that links tie together."""
    out = [near.grouped(_texts(spark, sf_dir, t).select("id", "text"), NEAR_3).select(F.lit(t).alias("table_name"), "id", "class_id", "group_id") for t in ("stage1_entry", "manifest")]
    return out[0].unionByName(out[1])


def _cross_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _texts(spark, sf_dir, "stage1_entry").filter("split in ('train', 'val', 'test')")
    return near.sided_pairs(near.near(rows.select("id", "text", (F.col("split") != "train").cast("tinyint").alias("side")), NEAR_5, sided=True))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cross_split(spark, sf_dir).select(F.least("x", "y").alias("entry_id_a"), F.greatest("x", "y").alias("entry_id_b"))


def _pairs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(record_id, field, prompt, answer) of stage2_variant and of both sides of stage2_pair; contents only."""
    said = lambda c: F.transform(c, lambda m: m["content"])
    variant = table(spark, sf_dir, "stage2_variant").select(F.col("variant_id").alias("record_id"), F.lit("variant_messages").alias("field"), said("prefix_messages").alias("prompt"), said("variant_messages").alias("answer"))
    pair = table(spark, sf_dir, "stage2_pair")
    sides = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), said(c).alias("answer")) for c in ("chosen", "rejected")])).alias("side")
    pair = pair.select(F.col("pair_id").alias("record_id"), said("messages").alias("prompt"), sides).select("record_id", "side.field", "prompt", "side.answer")
    return variant, pair


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    variant, pair = _pairs(spark, sf_dir)
    model = defects.fit(defects.sample_prompts(variant) + defects.sample_prompts(pair.filter("field = 'chosen'")))
    return defects.defective(variant.unionByName(pair), model)


def p5_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(split, source_id, n_rows, n_pairs): val and test rows that stand in train, and with how many rows."""
    by_row = _cross_split(spark, sf_dir).groupBy("y").agg(F.count("*").alias("n"))
    rows = table(spark, sf_dir, "stage1_entry").select(F.col("entry_id").alias("y"), "split", "source_id")
    return rows.join(by_row, "y").groupBy("split", "source_id").agg(F.count("*").alias("n_rows"), F.sum("n").alias("n_pairs"))


def _populations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(plan, category, id) of all plans."""
    label = table(spark, sf_dir, "manifest").filter("label is not null").select(F.lit("manifest_label").alias("plan"), F.lower(strip(F.col("label"))).alias("category"), F.col("row_id").alias("id"))
    entry = table(spark, sf_dir, "stage1_entry")
    size = F.size("messages")
    bucket = F.when(size.between(2, 6), "2-6").when(size.between(7, 10), "7-10").when(size.between(11, 16), "11-16").otherwise("17-999")
    kinds = F.array(F.struct(F.lit("entry_domain").alias("plan"), F.col("domain").alias("category")), F.struct(F.lit("entry_turns").alias("plan"), F.concat("domain", F.lit("/"), bucket).alias("category")))
    return label.unionByName(entry.select(F.explode(kinds).alias("k"), F.col("entry_id").alias("id")).select("k.plan", "k.category", "id"))


def _reservoirs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The reservoirs of one pass over all plans' populations, and the targets. The tables' footers tell how many rows a plan can have."""
    targets = table(spark, sf_dir, "sampling_target")
    upper = max(table(spark, sf_dir, t).count() for t in ("manifest", "stage1_entry"))
    return sampling.reservoirs(_populations(spark, sf_dir), targets, upper), targets


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.report(*_reservoirs(spark, sf_dir))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir).filter("exhausted").select("plan", "category")


def p2_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir).select("plan", "category", "population", "available", "required", "taken")


def p2_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sample's shares are from the targets."""
    return _report(spark, sf_dir).select("plan", "category", "target_pct", "achieved_pct", "exhausted")


def p2_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.sample(*_reservoirs(spark, sf_dir))


def _stored(spark: SparkSession, sf_dir: str, entries: DataFrame | None = None) -> components.Store:
    """A stored component table, brought up to date by two batches of the manifest, the earlier and the later half of its rows.

    Rows without a time come late. With ``entries``, splits are stored at both batches; else none.
    """
    manifest = table(spark, sf_dir, "manifest")
    middle = manifest.agg(F.percentile_approx("loaded_at", 0.5)).first()[0]
    rows = manifest.select("custom_id", "pid", F.coalesce(F.col("loaded_at") <= F.lit(middle), F.lit(False)).alias("early"))
    store = components.Store(spark, lasting_folder(spark, "components"))
    for early in (True, False):
        store.add(components.ties(rows.filter(F.col("early") == early)), entries)
    return store


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = table(spark, sf_dir, "stage1_entry").select("entry_id", "source_id", "split")
    return components.spread_rows(entries, _stored(spark, sf_dir).components())


def p4_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A new split for every group, over the whole stored table."""
    entries = table(spark, sf_dir, "stage1_entry").select("source_id", "split")
    known = _stored(spark, sf_dir).components()
    return components.assign(components.with_splits(components.component_groups(entries, known), known)).drop("component")


def p4_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(split, status, n_groups): what the second batch makes of the splits that the store holds since the first."""
    entries = table(spark, sf_dir, "stage1_entry").select("source_id", "split")
    return _stored(spark, sf_dir, entries).splits().groupBy("split", "status").agg(F.count("*").alias("n_groups"))


def _prints(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "manifest": formatting.prints(table(spark, sf_dir, "manifest"), "row_id", formatting.canonical_text(F.col("content"))),
        "stage1_entry": formatting.prints(table(spark, sf_dir, "stage1_entry"), "entry_id", formatting.canonical_messages(F.col("messages"))),
    }


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = [formatting.copies(p).select(F.lit(t).alias("table_name"), "record_id", "first_id") for t, p in _prints(spark, sf_dir).items()]
    return out[0].unionByName(out[1])


def p6_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record of each form, with its number of copies."""
    out = [formatting.kept_with_counts(p).select(F.lit(t).alias("table_name"), "first_id", "n_copies") for t, p in _prints(spark, sf_dir).items()]
    return out[0].unionByName(out[1])


def p6_characters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As p6_found over manifest.content, with characters that look the same made equal first."""
    rows = formatting.in_plain_characters(table(spark, sf_dir, "manifest").select("row_id", "content"), "row_id", "content")
    return formatting.copies(formatting.prints(rows, "row_id", formatting.canonical_text(F.col("content"))))


def _packed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    capacities = table(spark, sf_dir, "pack_capacity")
    return packing.pack(packing.token_counts(table(spark, sf_dir, "documents")), capacities), capacities


def p7_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _packed(spark, sf_dir)[0]


def p7_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.fill_report(*_packed(spark, sf_dir))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.leaked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_item"))


def p8_proximity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.Index(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_item")).proximity()


QUERIES = {
    f.__name__: f
    for f in (
        p1_found, p2_found, p2_report, p2_shares, p2_sample, p3_found, p3_groups, p4_found, p4_assignment, p4_update, p5_found, p5_report,
        p6_found, p6_kept, p6_characters, p7_sequences, p7_fill, p8_found, p8_proximity, p9_found, p9_marks, p9_forms, p9_groups,
    )
}

_BUCKET = "CASE WHEN len(messages) BETWEEN 2 AND 6 THEN '2-6' WHEN len(messages) BETWEEN 7 AND 10 THEN '7-10' WHEN len(messages) BETWEEN 11 AND 16 THEN '11-16' ELSE '17-999' END"
_REPORT = f"""WITH pop AS (SELECT 'manifest_label' plan, lower(regexp_replace(label, '^\\s+|\\s+$', '', 'g')) category FROM manifest WHERE label IS NOT NULL
UNION ALL SELECT 'entry_domain', domain FROM stage1_entry UNION ALL SELECT 'entry_turns', domain || '/' || {_BUCKET} FROM stage1_entry),
n AS (SELECT plan, count(*) population FROM pop GROUP BY 1), c AS (SELECT plan, category, count(*) available FROM pop GROUP BY ALL),
r AS (SELECT t.plan, t.category, coalesce(population, 0) population, coalesce(available, 0) available, greatest(min_rows, coalesce(population, 0) * sample_pct * target_pct // 10000)::BIGINT required FROM sampling_target t LEFT JOIN n USING (plan) LEFT JOIN c ON c.plan = t.plan AND c.category = t.category)"""
_TEXT = "array_to_string([coalesce(m.content, '') for m in messages], chr(10))"
_PAIRS = f"""WITH w AS (SELECT 'stage1_entry' t, entry_id id, regexp_extract_all(lower({_TEXT}), '[\\p{{L}}\\p{{N}}]+') w FROM stage1_entry
UNION ALL SELECT 'manifest', row_id, regexp_extract_all(lower(content), '[\\p{{L}}\\p{{N}}]+') FROM manifest),
s AS (SELECT DISTINCT t, id, unnest([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] for i in range(1, len(w) - 1)]) g FROM w WHERE len(w) >= 3),
n AS (SELECT t, id, count(*) n FROM s GROUP BY ALL),
p AS (SELECT a.t, a.id ia, b.id ib, count(*) k FROM s a JOIN s b ON a.t = b.t AND a.g = b.g AND a.id < b.id GROUP BY ALL),
found AS (SELECT p.t, ia, ib FROM p JOIN n x ON x.t = p.t AND x.id = ia JOIN n y ON y.t = p.t AND y.id = ib WHERE 2 * k >= x.n + y.n - k)"""
_CROSS = f"{_PAIRS}, crossing AS (SELECT ia, ib, a.split sa, b.split sb, a.source_id ca, b.source_id cb FROM found JOIN stage1_entry a ON a.entry_id = ia JOIN stage1_entry b ON b.entry_id = ib WHERE t = 'stage1_entry' AND a.split IN ('train', 'val', 'test') AND b.split IN ('train', 'val', 'test') AND (a.split = 'train') <> (b.split = 'train'))"
_BARE = lambda x: f"regexp_replace(replace(lower({x}), 'ß', 'ss'), '[^\\p{{L}}\\p{{N}}]+', '', 'g')"
_FORMS = f"""WITH f AS (SELECT 'manifest' t, row_id id, CASE WHEN json_valid(content) AND json_type(CASE WHEN json_valid(content) THEN content ELSE '0' END) = 'OBJECT' THEN
  '{{' || array_to_string(list_sort([{_BARE('k')} || chr(31) || coalesce({_BARE("json_extract_string(content, '$.\"' || k || '\"')")}, '') for k in json_keys(CASE WHEN json_valid(content) THEN content ELSE '{{}}' END)]), chr(30)) ELSE {_BARE('content')} END form FROM manifest WHERE content IS NOT NULL
UNION ALL SELECT 'stage1_entry', entry_id, len(messages) || chr(30) || array_to_string([coalesce(lower(m.role), '') || chr(31) || coalesce({_BARE('m.content')}, '') for m in messages], chr(30)) FROM stage1_entry WHERE messages IS NOT NULL),
g AS (SELECT t, id, min(id) OVER (PARTITION BY t, form) first_id, count(*) OVER (PARTITION BY t, form) n FROM f)"""
_SPREAD = """WITH RECURSIVE e AS (SELECT DISTINCT custom_id node, lower(regexp_replace(pid, '^\\s+|\\s+$', '', 'g')) k FROM manifest WHERE custom_id IS NOT NULL AND regexp_replace(pid, '\\s', '', 'g') <> ''),
r(a, b) AS (SELECT node, node FROM e UNION SELECT r.a, y.node FROM r JOIN e x ON x.node = r.b JOIN e y ON y.k = x.k),
c AS (SELECT a node, min(b) component FROM r GROUP BY 1),
s AS (SELECT entry_id, source_id, split, coalesce(component, source_id) component FROM stage1_entry LEFT JOIN c ON node = source_id WHERE source_id IS NOT NULL),
g AS (SELECT component, min(source_id) group_key FROM s GROUP BY 1 HAVING count(DISTINCT split) > 1)"""
_SPREAD_ALL = _SPREAD[: _SPREAD.rindex(",\ng AS")]
_ASSIGNED = """, g AS (SELECT min(source_id) group_key, count(*) group_rows, count(DISTINCT split) k, count(*) FILTER (split = 'train') a, count(*) FILTER (split = 'val') b, count(*) FILTER (split = 'test') c FROM s GROUP BY component),
f AS (SELECT group_key, group_rows, CASE k WHEN 0 THEN 'new' WHEN 1 THEN 'kept' ELSE 'settled' END status, CASE WHEN k = 0 THEN NULL WHEN a >= b AND a >= c THEN 'train' WHEN b >= c THEN 'val' ELSE 'test' END split FROM g),
t AS (SELECT sum(group_rows) n, sum(group_rows) FILTER (split = 'train') h1, sum(group_rows) FILTER (split = 'val') h2, sum(group_rows) FILTER (split = 'test') h3, sum(group_rows) FILTER (status = 'new') m FROM f),
l AS (SELECT coalesce(m, 0) m, greatest(0e0, 0.75e0 * n - coalesce(h1, 0)) l1, greatest(0e0, 0.1e0 * n - coalesce(h2, 0)) l2, greatest(0e0, 0.15e0 * n - coalesce(h3, 0)) l3 FROM t),
q AS (SELECT l1 * (m / (l1 + l2 + l3)) b1, l1 * (m / (l1 + l2 + l3)) + l2 * (m / (l1 + l2 + l3)) b2 FROM l),
placed AS (SELECT *, sum(group_rows) OVER (ORDER BY md5('42|' || group_key), group_key) - group_rows / 2e0 middle FROM f WHERE status = 'new')
SELECT group_key, group_rows, CASE WHEN middle <= b1 THEN 'train' WHEN middle <= b2 THEN 'val' ELSE 'test' END split, status FROM placed, q UNION ALL SELECT group_key, group_rows, split, status FROM f WHERE status <> 'new'"""
#: Code points as SQL patterns, written out here apart from the operator's own lists.
_NO_MARKS = r"[\x{34F}\x{17B4}\x{17B5}\x{20E3}\x{FE00}-\x{FE0F}\x{180B}-\x{180F}]"
_BLANKS = r"[\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_UNSEEN = r"[\x{AD}\x{34F}\x{61C}\x{115F}\x{1160}\x{17B4}\x{17B5}\x{180B}-\x{180E}\x{200B}\x{200C}\x{200E}\x{200F}\x{202A}-\x{202E}\x{2060}-\x{206F}\x{3164}\x{FEFF}\x{FFA0}\x{E0001}\x{200D}]"
_EMOJIS = r"\x{A9}\x{AE}\x{203C}\x{2049}\x{2122}\x{2139}\x{2194}-\x{21AA}\x{2300}-\x{23FF}\x{24C2}\x{25AA}-\x{27BF}\x{2934}\x{2935}\x{2B05}-\x{2B55}\x{3030}-\x{303D}\x{3297}-\x{3299}\x{1F000}-\x{1FAFF}"
_UNJOIN = lambda x: rf"regexp_replace({x}, '([{_EMOJIS}\x{{FE0F}}])\x{{200D}}([{_EMOJIS}])', '\1\2', 'g')"
_MARKS = rf"""SELECT doc_id, 'wide' kind FROM documents WHERE regexp_matches(text, '[\x{{FF01}}-\x{{FF5E}}\x{{FF61}}-\x{{FF9F}}]')
UNION ALL SELECT doc_id, 'combining' FROM documents WHERE regexp_matches(regexp_replace(text, '{_NO_MARKS}', '', 'g'), '\p{{M}}')
UNION ALL SELECT doc_id, 'space' FROM documents WHERE regexp_matches(text, '{_BLANKS}')
UNION ALL SELECT doc_id, 'invisible' FROM documents WHERE regexp_matches({_UNJOIN(_UNJOIN('text'))}, '{_UNSEEN}')"""
ORACLES: dict[str, str] = {
    "p9_marks": _MARKS,
    "p2_found": f"{_REPORT} SELECT plan, category FROM r WHERE available < required",
    "p2_report": f"{_REPORT} SELECT plan, category, population, available, required, least(available, required) taken FROM r",
    "p2_shares": f"{_REPORT} SELECT plan, category, target_pct, round(least(available, required) * 100e0 / sum(least(available, required)) OVER (PARTITION BY plan), 6) achieved_pct, available < required exhausted FROM r JOIN sampling_target USING (plan, category)",
    "p2_sample": f"{_REPORT}, ids AS (SELECT 'manifest_label' plan, lower(regexp_replace(label, '^\\s+|\\s+$', '', 'g')) category, row_id id FROM manifest WHERE label IS NOT NULL UNION ALL SELECT 'entry_domain', domain, entry_id FROM stage1_entry UNION ALL SELECT 'entry_turns', domain || '/' || {_BUCKET}, entry_id FROM stage1_entry), ranked AS (SELECT *, row_number() OVER (PARTITION BY plan, category ORDER BY ('0x' || substr(md5('42|' || plan || '|' || id), 1, 15))::BIGINT, id) k FROM ids) SELECT plan, category, id FROM ranked JOIN r USING (plan, category) WHERE k <= least(available, required)",
    "p3_found": f"{_PAIRS} SELECT t table_name, ia id_a, ib id_b FROM found",
    "p4_found": f"{_SPREAD} SELECT entry_id, group_key FROM s JOIN g USING (component)",
    "p4_assignment": f"{_SPREAD_ALL} {_ASSIGNED}",
    "p5_found": f"{_CROSS} SELECT ia entry_id_a, ib entry_id_b FROM crossing",
    "p5_report": f"{_CROSS}, held AS (SELECT CASE WHEN sa = 'train' THEN ib ELSE ia END id, CASE WHEN sa = 'train' THEN sb ELSE sa END split, CASE WHEN sa = 'train' THEN cb ELSE ca END source_id FROM crossing) SELECT split, source_id, count(DISTINCT id) n_rows, count(*) n_pairs FROM held GROUP BY ALL",
    "p6_found": f"{_FORMS} SELECT t table_name, id record_id, first_id FROM g WHERE n > 1",
    "p6_kept": f"{_FORMS} SELECT DISTINCT t table_name, first_id, n n_copies FROM g",
}
