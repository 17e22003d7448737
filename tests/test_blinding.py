"""Blinding against one substitution after another, and the forms of names and companies."""

import random
import re

from pyspark.sql import functions as F

from quillboard.operators import blinding as bl

PEOPLE = "subject string, name string, handles array<string>, affiliations array<string>, aliases array<string>"
PERSON = ("p", "Ben Lee Shapiro", ["Destiny"], ["The Daily Wire", "Google Cloud", "Games Inc."], ["The Destiny Show", "Wire Man", "Benny"])


def forms(spark, person=PERSON, known=("game", "twitch", "wire", "destiny")):
    df = bl.person_forms(spark.createDataFrame([person], PEOPLE), spark.createDataFrame([(w,) for w in known], "word string"))
    return df, df.first()["forms"]


def test_forms(spark):
    _, got = forms(spark)
    by = {f["form"]: (f["role"], f["any_case"], f["surname"]) for f in got}
    subject, company = ("subject", True, False), ("affiliation", True, False)
    assert by == {
        "Ben Lee Shapiro": subject, "Lee Shapiro": subject, "Shapiro": ("subject", True, True), "Ben": subject, "Destiny": subject, "The Destiny Show": subject, "Wire Man": company, "Benny": subject, "The Daily Wire": company, "Daily": company, "Wire": ("affiliation", False, False),
        "Google Cloud": company, "Google": company, "GCP": company, "GCS": company, "DWP": company, "DWS": company, "Games Inc.": company, "Games": ("affiliation", False, False), "GIP": company, "GIS": company,
    }
    assert [f["form"] for f in got][:5] == ["Ben Lee Shapiro", "Lee Shapiro", "Shapiro", "Ben", "Destiny"]
    nameless = spark.createDataFrame([("q", None, None, None, [None, ""])], PEOPLE)
    assert bl.person_forms(nameless, spark.createDataFrame([], "word string")).count() == 0


def one_after_another(text, forms, given):
    """Each form, the longest first, all over the text; then tokens on end become one."""
    n = {"subject": 0, "affiliation": 0, "kept": 0}
    for f in sorted(forms, key=lambda f: -len(f["form"])):
        form = f["form"] if f["any_case"] else f["form"][:1].upper() + f["form"][1:]
        pattern = re.compile(r"\b" + re.escape(form) + r"(?:'s|s')?\b", re.IGNORECASE if f["any_case"] else 0)

        def put(m, f=f):
            before = re.search(r"\b([A-Z][a-z]+)[ \t]+$", m.string[max(0, m.start() - 40) : m.start()])
            if f["surname"] and before and before[1].lower() in given and before[1] not in ("Ben", "Will"):
                n["kept"] += 1
                return m[0]
            n[f["role"]] += 1
            return bl.SUBJECT if f["role"] == "subject" else bl.AFFILIATION

        text = pattern.sub(put, text)
    for token in (bl.SUBJECT, bl.AFFILIATION):
        text = re.sub("(" + re.escape(token) + r"\s+){2,}", token + " ", text)
    return text, n["subject"], n["affiliation"], n["kept"]


def test_as_one_after_another(spark):
    df, some = forms(spark)
    r = random.Random(3)
    pieces = ["Ben", "ben lee shapiro", "Shapiro's", "Josh Shapiro", "Will Shapiro", "the destiny show", "Destiny", "destinys", "Google", "google cloud's", "GCP", "wire", "Wire", "The Daily Wire", "games", "Games", "Benny", "Bens'", "écru", "Shapiroé", "and", "said,", "wire man", "Josh ben", "Lee", "[x]", "josh Shapiro"]
    texts = [" ".join(r.choices(pieces, k=r.randint(0, 14))) for _ in range(300)] + ["", "BEN LEE SHAPIRO'S own", "Josh\tShapiro and Josh\nShapiro", "İBen Ben", "Ben-Shapiro"]
    rows = spark.createDataFrame([(k, "p", t) for k, t in enumerate(texts)] + [(900, "p", None), (901, "nobody", "Ben Shapiro"), (902, None, "Ben")], "key long, subject string, text string").repartition(3)
    got = {x["key"]: tuple(x)[1:] for x in bl.blind_texts(rows, df, ("Josh", "will")).collect()}
    assert len(got) == len(texts) + 3 and got[900] == (None, 0, 0, 0) and got[901][0] == "Ben Shapiro" and got[902][0] == "Ben"
    for k, t in enumerate(texts):
        assert got[k] == one_after_another(t, some, {"josh", "will"}), t


def test_misheard_words_go_last(spark):
    df, _ = forms(spark)
    rows = spark.createDataFrame([(1, "p", "Shapero met Josh Shapero, shapero's Ben Shapero"), (2, "p", "Shapero")], "key long, subject string, text string")
    heard = spark.createDataFrame([(1, "shapero", "subject")], "key long, word string, role string")
    got = {x["key"]: tuple(x)[1:] for x in bl.blind_texts(rows, df, ("Josh",), heard).collect()}
    assert got == {1: ("[SUBJECT] met Josh Shapero, [SUBJECT] [SUBJECT]", 4, 0, 1), 2: ("Shapero", 0, 0, 0)}


def test_plural_spellings(spark):
    words = spark.createDataFrame([("Parties",), ("Boxes",), ("Games",), ("is",)], "w string")
    assert [r["s"] for r in words.select(bl.ordinary(F.col("w")).alias("s")).collect()] == [["parties", "party", "parti", "partie"], ["boxes", "box", "boxe"], ["games", "gam", "game"], ["is", "i"]]
