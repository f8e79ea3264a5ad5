"""The fact store: merging claims, evidence, links, flags, decisions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mnemoweave.functions import text as X
from mnemoweave.operators.claims import claim_id, deduped, fact_id
from mnemoweave.session import checkpointed

#: Categories of which one fact holds at a time.
LATEST_ONLY = ("identity.name", "identity.handle", "identity.role", "identity.company")


def wanted_status(status: Column, derived_from: Column) -> Column:
    """accepted or needs_review; other values are accepted; what only the assistant said is never accepted."""
    s = F.coalesce(X.strip(status), F.lit("accepted"))
    s = F.when(s.isin("accepted", "needs_review"), s).otherwise("accepted")
    return F.when((derived_from == "assistant") & (s == "accepted"), "needs_review").otherwise(s)


def identified(claims: DataFrame) -> DataFrame:
    """Distinct claims with fact_id, claim_id, wanted status, as_of."""
    return (
        deduped(claims.where(X.is_text(F.col("category")) & X.is_text(F.col("fact"))))
        .withColumn("fact_id", fact_id(F.col("category"), F.col("fact"), F.col("value")))
        .withColumn("wanted", wanted_status(F.col("status"), F.col("derived_from")))
        .withColumn("as_of", F.col("time.as_of_ts"))
    )


def facts(claims: DataFrame) -> DataFrame:
    """The facts of a fresh store, in closed form: the fold over claims in order gives the same for ordinary categories.

    Times are the least and greatest known; the text is the latest dated one's (the later line of equals), else the first;
    stability is transient as soon as claims disagree; accepted once is accepted.
    """
    c = identified(claims).withColumn("__text", X.strip(F.col("fact"))).withColumn("__conf", F.when(F.isnan("confidence"), None).otherwise(F.col("confidence")))
    g = c.groupBy("fact_id").agg(
        F.min_by("category", "seq").alias("category"),
        F.coalesce(F.max_by("__text", F.when(F.col("as_of").isNotNull(), F.struct("as_of", "seq"))), F.min_by("__text", "seq")).alias("fact_text"),
        F.when(F.count_distinct("stability") > 1, "transient").otherwise(F.min_by("stability", "seq")).alias("stability"),
        F.min("as_of").alias("first_seen_ts"), F.max("as_of").alias("last_seen_ts"), F.max("__conf").alias("confidence_max"),
        F.when(F.bool_or(F.col("wanted") == "accepted"), "accepted").otherwise("needs_review").alias("status"), F.count("*").alias("claims"),
    )
    return g.withColumn("normalized_fact_text", X.normalized(F.col("fact_text")))


def merged(prior: DataFrame, claims: DataFrame, known: DataFrame | None = None, cutoff: DataFrame | None = None, imported_at: float | None = None) -> DataFrame:
    """The facts of a store after more claims: `prior` (as :func:`facts` gives them) with the claims folded in, in order of seq.

    Accepted and rejected facts stay so, whatever is claimed later; those up for review and superseded ones take the status
    wanted, accepted once being accepted. A rejected fact whose decision (``cutoff``: fact_id, decided_at) is older than
    `imported_at` goes to review with the first claim that the store doesn't have (``known``: claim_id); claims behind that one
    may accept it. Times, confidence, text and stability as in a fresh store, the prior row being the first sighting.
    Exclusive categories need :func:`fold_latest_only` on top.
    """
    c = claims.where(X.is_text(F.col("category")) & X.is_text(F.col("fact"))).withColumn("claim_id", claim_id(claims))
    c = c.withColumn("fact_id", fact_id(F.col("category"), F.col("fact"), F.col("value"))).withColumn("wanted", wanted_status(F.col("status"), F.col("derived_from")))
    if known is not None:
        c = c.join(known.select("claim_id", F.lit(True).alias("__known")).distinct(), "claim_id", "left")
    rows = c.select(
        "fact_id", "seq", "category", X.strip(F.col("fact")).alias("text"), "stability", F.col("time.as_of_ts").alias("first_ts"), F.col("time.as_of_ts").alias("last_ts"),
        F.when(F.isnan("confidence"), None).otherwise(F.col("confidence")).alias("conf"), F.lit(None).cast("string").alias("was"), "wanted",
        (F.col("__known").isNull() if known is not None else F.lit(True)).alias("new"), F.lit(0).cast("long").alias("told"),
    )
    before = prior.select(
        "fact_id", F.lit(None).cast("long").alias("seq"), "category", F.col("fact_text").alias("text"), "stability", F.col("first_seen_ts").alias("first_ts"), F.col("last_seen_ts").alias("last_ts"),
        F.col("confidence_max").alias("conf"), F.col("status").alias("was"), F.lit(None).cast("string").alias("wanted"), F.lit(False).alias("new"),
        (F.col("claims") if "claims" in prior.columns else F.lit(0)).cast("long").alias("told"),
    )
    order = F.coalesce("seq", F.lit(-(1 << 62)))  # the prior row comes first
    claimed = F.col("seq").isNotNull()
    g = before.unionByName(rows).withColumn("__o", order).groupBy("fact_id").agg(
        F.min_by("category", "__o").alias("category"),
        F.coalesce(
            F.max_by("text", F.when(F.col("last_ts").isNotNull(), F.struct("last_ts", "__o"))),
            F.min_by("text", F.when(X.is_text(F.col("text")), F.col("__o"))),
        ).alias("fact_text"),
        F.when(F.count_distinct("stability") > 1, "transient").otherwise(F.min_by("stability", "__o")).alias("stability"),
        F.min("first_ts").alias("first_seen_ts"), F.max("last_ts").alias("last_seen_ts"), F.max("conf").alias("confidence_max"), F.max("was").alias("__was"),
        F.coalesce(F.bool_or(F.col("wanted") == "accepted"), F.lit(False)).alias("__accepted"), F.max(F.when(F.col("wanted") == "accepted", F.col("seq"))).alias("__last_accepted"),
        F.min(F.when(F.col("new") & claimed, F.col("seq"))).alias("__first_new"), F.count_if(claimed).alias("__n"), F.sum("told").alias("__told"),
    )
    again = F.lit(False)
    if cutoff is not None and imported_at is not None:
        g = g.join(cutoff.select("fact_id", F.col("decided_at").alias("__cut")), "fact_id", "left")
        again = F.coalesce((F.col("__cut") < imported_at) & F.col("__first_new").isNotNull(), F.lit(False))
    open_status = F.when(F.col("__accepted"), "accepted").otherwise("needs_review")
    status = (
        F.when((F.col("__was") == "rejected") & again, F.when(F.col("__last_accepted") > F.col("__first_new"), "accepted").otherwise("needs_review"))
        .when(F.col("__was").isin("accepted", "rejected") | (F.col("__n") == 0), F.col("__was"))
        .otherwise(open_status)
    )
    out = g.withColumn("status", status).withColumn("claims", F.col("__told") + F.col("__n")).withColumn("normalized_fact_text", X.normalized(F.col("fact_text")))
    return out.select("fact_id", "category", "fact_text", "stability", "first_seen_ts", "last_seen_ts", "confidence_max", "status", "claims", "normalized_fact_text")


def latest_only(store: DataFrame, categories: tuple[str, ...] = LATEST_ONLY) -> DataFrame:
    """store with the losers of exclusive categories superseded.

    Winner: among accepted rows if any, else those to review: the latest, then the surest, then the least id. The best row
    per category is a map-side minimum; the table of winners has a row per category.
    """
    rank = F.struct(F.when(F.col("status") == "accepted", 0).otherwise(1).alias("a"), (-F.coalesce("last_seen_ts", F.lit(-1.0))).alias("b"), (-F.coalesce("confidence_max", F.lit(0.0))).alias("c"), F.col("fact_id").alias("winner"))
    active = F.col("category").isin(*categories) & F.col("status").isin("accepted", "needs_review")
    best = store.where(active).groupBy("category").agg(F.min(rank).alias("r")).select("category", F.col("r.winner").alias("__winner"))
    lost = active & (F.col("fact_id") != F.col("__winner"))
    return store.join(F.broadcast(best), "category", "left").withColumn("status", F.when(lost, "superseded").otherwise(F.col("status"))).select(*store.columns)


def fold_latest_only(claims: DataFrame, categories: tuple[str, ...] = LATEST_ONLY, prior: DataFrame | None = None) -> DataFrame:
    """(fact_id, category, status, last_seen_ts, confidence_max) of exclusive categories after claims file by file.

    After a file with evidence one fact of the category survives: of those active the best accepted one, else the best. So what
    competes is the survivor before and the facts told since. Files up to one with evidence form an epoch; the best
    accepted and the best other fact of each epoch are minima taken on the map side, and only facts that were best once
    are gone through epoch by epoch, a few rows per file. `prior` is a store to begin from. Rejected facts stay so.
    """
    has_evidence = F.size(F.coalesce("evidence", F.array().cast(claims.schema["evidence"].dataType))) > 0
    c = identified(claims).where(F.col("category").isin(*categories))
    told = c.groupBy("category", F.coalesce("file_no", F.lit(-1)).cast("long").alias("file_no"), "fact_id").agg(
        F.max("as_of").alias("ts"), F.max(F.when(~F.isnan("confidence"), F.col("confidence"))).alias("conf"),
        F.bool_or(F.col("wanted") == "accepted").alias("accepted"), F.bool_or(has_evidence).alias("evident"),
    )
    told = checkpointed(told)
    files = told.groupBy("category", "file_no").agg(F.max(F.col("evident").cast("int")).alias("one"))
    before = Window.partitionBy("category").orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    files = files.select("category", "file_no", F.coalesce(F.sum("one").over(before), F.lit(0)).alias("epoch"))
    ends = told.where("evident").select("category", "file_no").distinct().groupBy("category").agg(F.count("*").alias("__ends"))
    rows = told.join(files, ["category", "file_no"]).select("category", "epoch", "fact_id", "ts", "conf", "accepted", F.lit(True).alias("live"), F.lit(False).alias("rejected"))
    if prior is not None:
        old = prior.where(F.col("category").isin(*categories))
        rows = rows.unionByName(
            old.select(
                "category", F.lit(0).cast("long").alias("epoch"), "fact_id", F.col("last_seen_ts").alias("ts"), F.col("confidence_max").alias("conf"), (F.col("status") == "accepted").alias("accepted"),
                F.col("status").isin("accepted", "needs_review").alias("live"), (F.col("status") == "rejected").alias("rejected"),
            )
        )
    fact = Window.partitionBy("category", "fact_id")
    so_far = fact.orderBy("epoch").rowsBetween(Window.unboundedPreceding, 0)
    step = rows.groupBy("category", "epoch", "fact_id").agg(F.max("ts").alias("ts"), F.max("conf").alias("conf"), F.bool_or("accepted").alias("accepted"), F.bool_or("live").alias("live"), F.bool_or("rejected").alias("rejected"))
    step = step.withColumn("ts", F.max("ts").over(so_far)).withColumn("conf", F.max("conf").over(so_far)).withColumn("rejected", F.max("rejected").over(fact))
    step = checkpointed(step.join(F.broadcast(ends), "category", "left").withColumn("ended", F.col("epoch") < F.coalesce("__ends", F.lit(0))))  # a row per category
    rank = F.struct((-F.coalesce("ts", F.lit(-1.0))).alias("a"), (-F.coalesce("conf", F.lit(0.0))).alias("b"), F.col("fact_id").alias("id"))
    best = step.where("live and ended and not rejected").groupBy("category", "epoch", "accepted").agg(F.min(rank).alias("r")).select("category", "epoch", F.col("r.id").alias("fact_id"), F.lit(True).alias("best"))
    ever = best.select("category", "fact_id").distinct()
    few = step.where("live and ended and not rejected").join(ever, ["category", "fact_id"]).join(best, ["category", "epoch", "fact_id"], "left")

    def run(df: pd.DataFrame) -> pd.DataFrame:
        place = lambda r: (1.0 if pd.isna(r[1]) else -r[1], 0.0 if pd.isna(r[2]) else -r[2], r[0])
        now = None  # (fact_id, ts, conf, accepted)
        for _, epoch in df.groupby("epoch", sort=True):
            told = {r.fact_id: (r.fact_id, r.ts, r.conf, bool(r.accepted)) for r in epoch.itertuples() if pd.notna(r.best) or now is not None and r.fact_id == now[0]}
            if now is not None:
                again = told.get(now[0], now)
                told[now[0]] = (*again[:3], now[3] or again[3])
            pool = [r for r in told.values() if r[3]] or list(told.values())
            now = min(pool, key=place)
        return pd.DataFrame([(df["category"].iloc[0], now[0], now[3])], columns=["category", "__winner", "__sure"])

    winners = few.groupBy("category").applyInPandas(run, "category string, __winner string, __sure boolean")
    per = step.groupBy("category", "fact_id").agg(
        F.bool_or("rejected").alias("rejected"), F.max("ts").alias("last_seen_ts"), F.max("conf").alias("confidence_max"),
        F.bool_or(F.col("live") & ~F.col("ended")).alias("open"), F.coalesce(F.bool_or(F.when(~F.col("ended"), F.col("accepted"))), F.lit(False)).alias("open_accepted"),
    )
    mine = F.coalesce(F.col("fact_id") == F.col("__winner"), F.lit(False))
    sure = F.col("open_accepted") | (mine & F.coalesce("__sure", F.lit(False)))
    status = F.when(F.col("rejected"), "rejected").when(~mine & ~F.col("open"), "superseded").when(sure, "accepted").otherwise("needs_review")
    return per.join(F.broadcast(winners), "category", "left").select("fact_id", "category", status.alias("status"), "last_seen_ts", "confidence_max")  # a row per category


def evidence_rows(claims: DataFrame) -> DataFrame:
    """(evidence_id, fact_id, conv_id, message_id, ts, role, quote, quote_hash): each evidence once, the first of its kind.
    Items without quote, conversation, message or a known role are left out."""
    e = identified(claims).select("fact_id", "seq", F.posexplode("evidence").alias("pos", "e")).select("fact_id", "seq", "pos", "e.*")
    e = e.where(X.is_text(F.col("quote")) & X.is_text(F.col("conv_id")) & X.is_text(F.col("message_id")) & F.col("role").isin("user", "assistant"))
    e = e.withColumn("quote_hash", F.sha2("quote", 256)).withColumn("evidence_id", X.content_id(*map(F.col, ("fact_id", "conv_id", "message_id", "role", "quote_hash"))))
    g = e.groupBy("evidence_id").agg(F.min_by(F.struct("fact_id", "conv_id", "message_id", "ts", "role", "quote", "quote_hash"), F.struct("seq", "pos")).alias("r"))
    return g.select("evidence_id", "r.*")


def links(claims: DataFrame) -> DataFrame:
    """(fact_id, claim_id) of claims with evidence."""
    return identified(claims).where("size(evidence) > 0").select("fact_id", "claim_id").distinct()


def stability_flags(claims: DataFrame) -> DataFrame:
    """(fact_id, was, became): facts whose claims disagree on stability, with the first disagreement."""
    c = identified(claims).groupBy("fact_id").agg(F.min_by("stability", "seq").alias("was"), F.count_distinct("stability").alias("n")).where("n > 1")
    other = identified(claims).join(c, "fact_id").where("stability <> was").groupBy("fact_id", "was").agg(F.min_by("stability", "seq").alias("became"))
    return other


def conflicts(store: DataFrame, categories: tuple[str, ...] = LATEST_ONLY, least: float = 0.7) -> DataFrame:
    """(category, fact_id, rivals, first_rivals): every sure and stable active fact of a category that has several.

    Only the five first rivals are named."""
    live = store.where(F.col("category").isin(*categories) & F.col("status").isin("accepted", "needs_review") & (F.col("stability") == "stable") & (F.col("confidence_max") >= least))
    # two steps: a hot category is split by a hash of its facts, the best five of each part compete
    order = F.struct((-F.col("confidence_max")).alias("a"), (-F.coalesce("last_seen_ts", F.lit(-1.0))).alias("b"), F.col("fact_id").alias("c"))
    part = live.withColumn("__p", F.pmod(F.xxhash64("fact_id"), F.lit(64))).withColumn("__o", order)
    five = part.withColumn("__r", F.row_number().over(Window.partitionBy("category", "__p").orderBy("__o"))).where("__r <= 5")
    top = five.groupBy("category").agg(F.slice(F.array_sort(F.collect_list("__o")), 1, 5).alias("top"))  # 320 rows of a category at most
    per = live.groupBy("category").agg(F.count("*").alias("rivals")).where("rivals > 1").join(top, "category")
    return live.join(F.broadcast(per), "category").select("category", "fact_id", "rivals", F.array_join(F.transform("top", lambda t: t["c"]), ",").alias("first_rivals"))


def merge_stats(claims: DataFrame) -> DataFrame:
    """One row: claims read, new ones, facts, evidence."""
    c = identified(claims)
    return (
        claims.agg(F.count("*").alias("claims"))
        .crossJoin(F.broadcast(c.agg(F.count("*").alias("claims_new"), F.count_distinct("fact_id").alias("facts"))))  # one row each
        .crossJoin(F.broadcast(evidence_rows(claims).agg(F.count("*").alias("evidence"))))
    )


# -- decisions ----------------------------------------------------------------------------------------------------

# Words for a decision.
ACTIONS = {"accept": "accepted", "accepted": "accepted", "reject": "rejected", "rejected": "rejected", "needs_review": "needs_review", "review": "needs_review"}


def action_status(action: Column) -> Column:
    """The status that an action asks for; null for blank and unknown ones."""
    a = F.lower(X.strip(action))
    out = F.lit(None).cast("string")
    for word, status in ACTIONS.items():
        out = F.when(a == word, status).otherwise(out)
    return out


def decide(store: DataFrame, actions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(store, audit) after actions (seq, fact_id, action) in order. The audit has what each decision found and set."""
    known = actions.withColumn("new_status", action_status(F.col("action"))).where("new_status is not null").join(store.select("fact_id", F.col("status").alias("__was")), "fact_id")
    before = F.lag("new_status").over(Window.partitionBy("fact_id").orderBy("seq"))
    audit = known.withColumn("previous_status", F.coalesce(before, F.col("__was"))).select("seq", "fact_id", "action", "previous_status", "new_status")
    last = known.groupBy("fact_id").agg(F.max_by("new_status", "seq").alias("__new"))
    return store.join(last, "fact_id", "left").withColumn("status", F.coalesce("__new", "status")).select(*store.columns), audit


def review_id(audit: DataFrame) -> Column:
    """Identity of a decision in its place: the hash of its canonical JSON. Replaying a file's line gives the same one."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    key = F.struct(
        F.col("action"), text("decided_by").alias("decided_by"), F.col("fact_id"), F.col("new_status"), text("reason").alias("reason"),
        F.coalesce("source_line", F.lit(0)).alias("source_line"), F.col("source_path"),
    )
    return F.sha2(F.to_json(key, {"ignoreNullFields": "false"}), 256)


def flag_id(fact: Column, flag_type: str, detail: str) -> Column:
    """Identity of a flag: of each fact, kind and what it was raised for there is one."""
    return F.sha2(F.concat_ws("\n", fact, F.lit(flag_type), F.lit(detail)), 256)


def new_reviews(audit: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """The audit's rows with ``review_id``, the first of each; those that the store has are left out, so their time stays."""
    rest = F.struct(*audit.columns)
    out = audit.withColumn("review_id", review_id(audit)).groupBy("review_id").agg(F.min_by(rest, "seq").alias("r")).select("review_id", "r.*")
    return out if stored is None else out.join(stored.select("review_id"), "review_id", "left_anti")


def given_decisions(actions: DataFrame, accept: tuple[str, ...] = (), reject: tuple[str, ...] = (), needs_review: tuple[str, ...] = ()) -> DataFrame:
    """actions (seq, fact_id, action, ...) with decisions given by hand behind them, in this order: accept, reject, needs_review."""
    by_hand = [(f, a) for a, ids in (("accept", accept), ("reject", reject), ("needs_review", needs_review)) for f in ids]
    if not by_hand:
        return actions
    spark = actions.sparkSession
    last = actions.agg(F.coalesce(F.max("seq"), F.lit(0)).alias("__last"))
    rows = spark.createDataFrame([(i + 1, f, a) for i, (f, a) in enumerate(by_hand)], "n long, fact_id string, action string")
    more = rows.crossJoin(F.broadcast(last)).select((F.col("__last") + F.col("n")).alias("seq"), "fact_id", "action")  # one row of the last
    return actions.unionByName(more, allowMissingColumns=True)


def mismatches(actions: DataFrame, store: DataFrame, strict: bool = False) -> DataFrame:
    """(seq, fact_id, field, said, stored): actions that name a category or a text other than the store's; null names nothing.

    With `strict` the first of them is an error.
    """
    named = [c for c in ("category", "fact_text") if c in actions.columns]
    both = actions.select("seq", "fact_id", *[F.col(c).alias(f"__{c}") for c in named]).join(store.select("fact_id", *named), "fact_id")
    each = F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"__{c}").alias("said"), F.col(c).alias("stored")) for c in named])
    out = both.select("seq", "fact_id", F.explode(each).alias("m")).select("seq", "fact_id", "m.*").where("said is not null and not (said <=> stored)")
    if strict and (r := out.orderBy("seq", "field").first()) is not None:
        raise ValueError(f"action {r['seq']} on {r['fact_id']}: {r['field']} is not the store's")
    return out


def cutoffs(audit: DataFrame, at: str = "decided_at") -> DataFrame:
    """Per fact the last time it was accepted or rejected."""
    return audit.where(F.col("new_status").isin("accepted", "rejected")).groupBy("fact_id").agg(F.max(at).alias(at))


def reopened(store: DataFrame, cutoff: DataFrame, new_claims: DataFrame, at: str = "decided_at") -> DataFrame:
    """store where rejected facts with claims (fact_id, imported_at) later than their decision are up for review again."""
    later = new_claims.groupBy("fact_id").agg(F.max("imported_at").alias("__i")).join(cutoff, "fact_id").where(F.col("__i") > F.col(at)).select("fact_id", F.lit(True).alias("__again"))
    return store.join(later, "fact_id", "left").withColumn("status", F.when((F.col("status") == "rejected") & F.col("__again"), "needs_review").otherwise(F.col("status"))).select(*store.columns)
