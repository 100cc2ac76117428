"""From per-signal probabilities to a grade and a contact wave."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from leadsieve import constants as C
from leadsieve.functions.text import fixed, rounded
from leadsieve.operators.selection import latest_by, order_value

PREFIX = {"disqualifier": "dq__", "fit": "fit__", "anti-fit": "anti__", "momentum": "mom__"}
SHORT = {"disqualifier": "dq", "fit": "fit", "anti-fit": "anti", "momentum": "mom"}


@dataclass(frozen=True)
class Signal:
    """One rubric question; disqualifiers carry their rule as text."""

    kind: str
    id: str
    text: str
    weight: str = ""

    @property
    def qid(self) -> str:
        return PREFIX[self.kind] + self.id


@dataclass(frozen=True)
class Thresholds:
    present: float = C.SIGNAL_PRESENT
    disqualifies: float = C.DISQUALIFIER_FIRES
    torn: float = C.TORN_MARGIN
    review: float = C.REVIEW_CONFIDENCE

    def bar(self, kind: str) -> float:
        return self.disqualifies if kind == "disqualifier" else self.present


def distinct_signals(signals: list[Signal]) -> list[Signal]:
    """One signal per question: a later one with the same kind and id takes the place of an earlier one."""
    return list({s.qid: s for s in signals}.values())


def signals_table(spark: SparkSession, signals: list[Signal],
                  limits: Thresholds = Thresholds()) -> DataFrame:
    """The rubric's signals as a small table with rubric order and threshold."""
    rows = [(s.qid, s.kind, s.id, s.text, s.weight, i, limits.bar(s.kind))
            for i, s in enumerate(distinct_signals(signals))]
    return spark.createDataFrame(rows, "qid string, kind string, id string, text string, "
                                       "weight string, ord int, threshold double")


def answers_with_signals(answers: DataFrame, signals: list[Signal],
                         limits: Thresholds = Thresholds()) -> DataFrame:
    """Each answer with its signal. A rubric is a hand-written list, so it is broadcast."""
    table = signals_table(answers.sparkSession, signals, limits)
    return answers.join(F.broadcast(table), "qid").withColumn(
        "present", F.col("noul") >= F.col("threshold"))


def _p(signal: Signal) -> Column:
    return F.col(f"`p_{signal.qid}`")


def answers_wide(answers: DataFrame, signals: list[Signal]) -> DataFrame:
    """One row per domain with the latest probability of every signal.

    A single hash aggregate: repeated answers fold before the shuffle, and everything
    after it is projection. A null seq comes before all others.
    """
    order = order_value(answers, "seq")

    def latest(s: Signal) -> Column:
        mine = F.col("qid") == s.qid
        return F.max_by(F.when(mine, F.col("noul")), F.when(mine, order)).alias(f"p_{s.qid}")

    return answers.groupBy("domain").agg(*[latest(s) for s in distinct_signals(signals)])


def complete_answers(wide: DataFrame, signals: list[Signal]) -> DataFrame:
    """Domains with an answer to every question; the others stay pending."""
    return wide.dropna(how="any", subset=[f"p_{s.qid}" for s in signals]) if signals else wide


def signal_rollup(wide: DataFrame, signals: list[Signal],
                  limits: Thresholds = Thresholds()) -> DataFrame:
    """Per kind: hits, strong hits, first hit in rubric order; and the list of hits."""
    signals = distinct_signals(signals)

    def hit(s: Signal) -> Column:
        return _p(s) >= limits.bar(s.kind)

    def count(items: list[Signal]) -> Column:
        total = F.lit(0)
        for s in items:
            total = total + F.when(hit(s), 1).otherwise(0)
        return total

    def first(items: list[Signal]) -> Column:
        return F.coalesce(*[F.when(hit(s), F.lit(s.id)) for s in items],
                          F.lit(None).cast("string"))

    columns = []
    for kind, short in SHORT.items():
        mine = [s for s in signals if s.kind == kind]
        strong = [s for s in mine if s.weight == "strong"]
        ids = F.filter(F.array(*[F.when(hit(s), F.lit(s.id)) for s in mine], F.lit(None).cast("string")),
                       lambda x: x.isNotNull())
        columns += [count(mine).alias(f"n_{short}"), count(strong).alias(f"n_strong_{short}"),
                    first(mine).alias(f"first_{short}"),
                    first(strong).alias(f"first_strong_{short}"), ids.alias(f"ids_{short}")]
    shape = "array<struct<kind:string,id:string,text:string,p:double>>"
    present = F.array(*[F.when(hit(s), F.struct(
        F.lit(s.kind).alias("kind"), F.lit(s.id).alias("id"), F.lit(s.text).alias("text"),
        rounded(_p(s), 3).alias("p"))) for s in signals]).cast(shape)
    return wide.select("*", *columns,
                       F.filter(present, lambda x: x.isNotNull()).alias("signals_present"))


def _pick(grade: Column, values: list) -> Column:
    return F.when(grade == "Good", values[0]).when(grade == "Avg", values[1]).otherwise(values[2])


def decide(answers: DataFrame, grades: DataFrame, signals: list[Signal],
           limits: Thresholds = Thresholds()) -> DataFrame:
    """The decision for every domain with complete answers.

    answers: (domain, qid, noul, seq). grades: (domain, choice, p_good, p_avg, p_unfit,
    confidence, seq); the latest of a domain counts. Without `seq`, one row per domain.
    """
    return decide_wide(answers_wide(answers, signals), grades, signals, limits)


def decide_wide(wide: DataFrame, grades: DataFrame, signals: list[Signal],
                limits: Thresholds = Thresholds()) -> DataFrame:
    """`decide` on answers that are one row per domain already."""
    signals = distinct_signals(signals)
    if "seq" in grades.columns:
        grades = latest_by(grades, "domain").drop("seq")
    rolled =signal_rollup(complete_answers(wide, signals), signals, limits)
    p = [F.coalesce(F.col(c), F.lit(0.0)) for c in ("p_good", "p_avg", "p_unfit")]
    largest = F.when((p[0] >= p[1]) & (p[0] >= p[2]), "Good").when(p[1] >= p[2], "Avg") \
        .otherwise("Unfit")
    top = F.when(F.col("choice").isin(C.GRADES), F.col("choice")).otherwise(largest)
    asked = rolled.join(grades, "domain").withColumn("_top", top)
    lower = _pick(F.col("_top"), [F.lit("Avg"), F.lit("Unfit"), F.lit(None)])
    graded = asked.select(
        "*", _pick(F.col("_top"), p).alias("_p_top"), lower.alias("_lower"),
        _pick(F.col("_top"), [p[1], p[2], F.lit(None)]).alias("_p_lower"),
    ).withColumn("_torn", F.coalesce(F.col("_p_top") - F.col("_p_lower") < limits.torn, F.lit(False)))
    graded = graded.withColumn("_grade", F.when(F.col("_torn"), F.col("_lower")).otherwise(F.col("_top")))
    out = F.col("n_dq") > 0
    forced = (F.col("n_strong_anti") > 0) & (F.col("_grade") != "Unfit")
    fitment = F.when(out | forced, "Unfit").otherwise(F.col("_grade"))
    verdicts = graded.withColumn("_forced", forced).withColumn("fitment", fitment)
    ranking = (
        F.when(F.col("fitment") == "Unfit", 3)
        .when(F.col("fitment") == "Good", F.when(F.col("n_mom") > 0, 1).otherwise(2))
        .otherwise(F.when(F.col("n_strong_mom") > 0, 2).otherwise(3))
    )
    signals_map = F.create_map(*[x for s in signals for x in (F.lit(s.qid), rounded(_p(s), 3))]) \
        if signals else F.create_map().cast("map<string,double>")
    probabilities = F.create_map(*[x for g, q in zip(C.GRADES, p) for x in (F.lit(g), rounded(q, 3))])
    confidence = F.coalesce(F.col("confidence"), F.lit(0.0))
    return verdicts.select(
        "domain", "fitment", ranking.alias("ranking"), decision_why().alias("why"),
        F.col("first_dq").alias("disqualified_by"),
        probabilities.alias("fitment_probabilities"),
        rounded(confidence, 3).alias("fitment_confidence"), "signals_present",
        signals_map.alias("signals"), review_flags(confidence, limits).alias("needs_review"))


def decision_why() -> Column:
    """The readable reason, from the working columns of `decide`."""
    dq = F.col("n_dq") > 0
    torn = F.concat(F.lit("torn with "), F.col("_lower"), F.lit(" p="),
                    fixed(F.col("_p_lower"), 2), F.lit(", took the lower grade"))
    momentum = F.when(F.col("n_mom") > 0, F.concat(
        F.lit("momentum "), F.array_join("ids_mom", ", "))).otherwise("no momentum signal")
    graded = F.concat_ws(
        "; ", F.concat(F.lit("fitment "), F.col("_top"), F.lit(" p="), fixed(F.col("_p_top"), 2)),
        F.when(F.col("_torn"), torn),
        F.when(F.col("_forced"), F.concat(F.lit("strong anti-fit "), F.col("first_strong_anti"))),
        F.when(F.col("fitment") != "Unfit", momentum))
    return F.when(dq, F.concat(F.lit("disqualified by "), F.col("first_dq"))).otherwise(graded)


def review_flags(confidence: Column, limits: Thresholds) -> Column:
    """Notes for a human: low confidence, or Good without any fit signal."""
    kept = F.col("n_dq") == 0
    notes = F.array(
        F.when(kept & (confidence < limits.review),
               F.concat(F.lit("low fitment confidence "), fixed(confidence, 2))),
        F.when(kept & (F.col("fitment") == "Good") & (F.col("n_fit") == 0),
               F.lit("Good with no fit signal found on the site")))
    return F.filter(notes, lambda n: n.isNotNull())


def incremental_decide(sites: DataFrame, answers: DataFrame, grades: DataFrame,
                       decisions: DataFrame, signals: list[Signal],
                       done: DataFrame | None = None) -> DataFrame:
    """Decisions for gate-passed domains that have none yet; a rerun adds nothing.

    Answers fold to one row per domain before they meet the open domains, so a domain
    with very many answers is small by then, and the join reuses their partitioning.
    """
    open_sites = sites.where("gate_ok").select("domain").join(
        decisions.select("domain"), "domain", "left_anti")
    if done is not None:
        open_sites = open_sites.join(done.select("domain"), "domain", "left_anti")
    wide = answers_wide(answers, signals).join(open_sites, "domain", "left_semi")
    return decide_wide(wide, grades, signals)


# --- questions ----------------------------------------------------------------

def _with_spaces(json: Column, pairs: Column, commas: Column) -> Column:
    """Length of a JSON text written with a blank after every colon and comma."""
    return F.length(json) + pairs + commas


def build_questions(signals: DataFrame, rubrics: DataFrame) -> DataFrame:
    """The question list of each rubric.

    signals: (campaign, kind, ord, id, text, weight, evidence). rubrics: (campaign,
    offering, good, avg, unfit). `chars` is the serialized length of one question.
    """
    usable = signals.where((F.coalesce("id", F.lit("")) != "")
                           & ((F.col("kind") == "disqualifier") | (F.coalesce("text", F.lit("")) != "")))
    prefix = F.coalesce(*[F.when(F.col("kind") == k, F.lit(v)) for k, v in PREFIX.items()])
    proof = F.coalesce(F.nullif(F.col("evidence"), F.lit("")), F.lit(C.DEFAULT_PROOF))
    timing = F.col("kind") == "momentum"
    asked = usable.select(
        "campaign", F.concat(prefix, F.col("id")).alias("qid"), F.lit("noul").alias("type"),
        F.concat(F.when(timing, C.ASK_TIMING).otherwise(C.ASK_TRUE),
                 F.coalesce("text", F.lit("")), F.lit(C.ASK_END)).alias("instructions"),
        F.when(F.col("kind") == "disqualifier", F.concat(F.lit(C.PROOF), proof))
        .when(timing, C.SHOWN_SIGN).otherwise(C.SHOWN).alias("_yes"))
    criteria = F.struct(F.col("_yes").alias("true"), F.lit(C.NOT_SHOWN).alias("false"))
    body = F.to_json(F.struct("type", "instructions", criteria.alias("criteria")))
    key = F.length(F.to_json(F.array("qid"))) - 2 + 2
    nouls = asked.select("campaign", "qid", "type", "instructions",
                         F.to_json(criteria).alias("criteria"),
                         (key + _with_spaces(body, F.lit(5), F.lit(3))).cast("bigint").alias("chars"))
    return nouls.unionByName(_grade_question(usable, rubrics))


def _grade_question(signals: DataFrame, rubrics: DataFrame) -> DataFrame:
    """The Good/Avg/Unfit question; one rubric is a short hand-written list."""
    def texts(test: Column) -> Column:
        return F.transform(F.array_sort(F.collect_list(F.when(test, F.struct("ord", "text")))),
                           lambda s: s["text"])

    fit = F.col("kind") == "fit"
    lists = signals.groupBy("campaign").agg(
        texts(fit & (F.col("weight") == "strong")).alias("_strong"), texts(fit).alias("_fit"),
        texts(F.col("kind") == "anti-fit").alias("_anti"))
    none = F.array().cast("array<string>")
    every = rubrics.join(lists, "campaign", "left").select(
        "campaign", "offering",
        *[F.coalesce(F.nullif(F.col(g.lower()), F.lit("")), F.lit(C.DEFAULT_TIERS[g]))
          .alias(f"_{g.lower()}") for g in C.GRADES],
        F.coalesce(F.when(F.size("_strong") > 0, F.col("_strong")).otherwise(F.col("_fit")), none)
        .alias("_look"),
        F.coalesce("_anti", none).alias("_anti"))

    def filled(col: str) -> Column:
        return F.when(F.size(col) > 0, F.col(col))

    offering = F.nullif(F.coalesce("offering", F.lit("")), F.lit(""))
    instructions = F.struct(
        F.lit(C.GRADE_ASK).alias("question"), offering.alias("what_we_sell"),
        F.lit(C.GRADE_JUDGE_ON).alias("judge_on"), F.lit(C.GRADE_TIEBREAKER).alias("tiebreaker"))
    criteria = F.struct(
        F.struct(F.col("_good").alias("definition"), filled("_look").alias("look_for")).alias("Good"),
        F.struct(F.col("_avg").alias("definition"), F.lit(C.GRADE_AVG_ALSO).alias("also")).alias("Avg"),
        F.struct(F.col("_unfit").alias("definition"), filled("_anti").alias("look_for"),
                 F.lit(C.GRADE_UNFIT_ALSO).alias("also")).alias("Unfit"))
    body = F.to_json(F.struct(F.lit("choice").alias("type"), instructions.alias("instructions"),
                              criteria.alias("criteria")))

    def one(test: Column) -> Column:
        return F.when(test, 1).otherwise(0)

    sold, looked, anti = one(offering.isNotNull()), one(F.size("_look") > 0), one(F.size("_anti") > 0)
    pairs = F.lit(3) + 3 + sold + 3 + (1 + looked) + 2 + (2 + anti)
    listed = F.greatest(F.size("_look") - 1, F.lit(0)) + F.greatest(F.size("_anti") - 1, F.lit(0))
    commas = pairs - 6 + listed
    return every.select(
        "campaign", F.lit("fitment").alias("qid"), F.lit("choice").alias("type"),
        F.to_json(instructions).alias("instructions"), F.to_json(criteria).alias("criteria"),
        (F.lit(len('"fitment": ')) + _with_spaces(body, pairs, commas)).cast("bigint").alias("chars"))


def questions_chars(questions: DataFrame) -> DataFrame:
    """Serialized length of each rubric's whole question list."""
    return questions.groupBy("campaign").agg(
        (F.sum("chars") + 2 + 2 * (F.count("*") - 1)).alias("question_chars"))


def build_state(digest: Column, context: Column) -> Column:
    """The judged state as JSON: the website, and the lead record if there is one."""
    return F.to_json(F.struct(F.coalesce(digest, F.lit("")).alias("website"),
                              F.nullif(context, F.lit("")).alias("lead_record")))


def estimate_tokens(digest: Column, context: Column, question_chars: Column) -> Column:
    """About four characters a token; the state is read once per request."""
    extra = F.when(F.coalesce(context, F.lit("")) != "", 3).otherwise(1)
    return F.floor((F.length(build_state(digest, context)) + extra + question_chars) / 4)


def estimate_cost(states: DataFrame, cap: float = C.MAX_SPEND_USD) -> DataFrame:
    """Total tokens, price, and whether the price stays within the cap."""
    total = states.agg(F.count("*").alias("domains"),
                       F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"))
    usd = F.col("tokens") * F.lit(C.USD_PER_MILLION_TOKENS) / F.lit(1e6)
    return total.select("domains", "tokens", usd.alias("usd"), (usd <= cap).alias("within_cap"))


def spend_guard(work: DataFrame, cost: Column, confirmed: bool = False,
                cap: float = C.MAX_SPEND_USD) -> DataFrame:
    """Flag batches whose cost needs confirmation before they run."""
    return work.withColumn("allowed", F.lit(confirmed) | (cost <= cap))


def budget_headroom(used: Column, limit: Column,
                    headroom: float = C.BUDGET_HEADROOM_USD) -> Column:
    """Whether enough budget is left to start; unknown budgets do not stop a run."""
    known = used.isNotNull() & (F.coalesce(limit, F.lit(0.0)) != 0)
    return F.when(known, limit - used > headroom).otherwise(F.lit(True))
