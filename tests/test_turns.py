"""Turns and quotes among tokens against plain searches."""

import random
import re

from pyspark.sql import functions as F

from quillboard.operators import turns as tn


def norm(t):
    return "" if re.fullmatch(r"\[\d\d:\d\d:\d\d\]|>{2,}", t) else re.sub(r"[^\w']", "", t.lower())


def plain_turns(tokens, turns):
    words, starts = [norm(t) for t in tokens], []
    for n, marker, first, speaker in turns:
        m = max(0, min(marker, len(tokens) - 1))
        want = [w for w in map(norm, (first or "").split()) if w][:5]
        hits = [i for i in range(m, min(len(tokens), m + 40)) if want and words[i] and [w for w in words[i : i + len(want) + 3] if w][: len(want)] == want]
        starts.append((hits[0] if hits else m, n, speaker, bool(hits)))
    starts.sort()
    ends = [s[0] for s in starts[1:]] + [len(tokens)]
    return [(n, s, e, who, found) for (s, n, who, found), e in zip(starts, ends, strict=True) if e > s]


def test_turns(spark):
    r = random.Random(4)
    words = "so, well I'm not sure That's it [00:01:00] >> yes. no; we go “up” é".split()
    recordings, turns = [(0, []), (1, ["one"])], [(0, 0, 3, "x", "a"), (1, 0, -5, "ONE!", "a"), (1, 1, 99, None, "b"), (77, 0, 0, "x", "a")]
    for k in range(2, 40):
        tokens = r.choices(words, k=r.randint(1, 120))
        recordings.append((k, tokens))
        for n in range(r.randint(1, 6)):
            at = r.randrange(len(tokens))
            first = " ".join(tokens[at : at + r.randint(0, 8)])
            turns.append((k, n, max(-3, at - r.choice([0, 3, 20, 39, 40, 60])), r.choice([first, first.upper(), first.replace(",", ""), "nothing like it", None]), r.choice("ab")))
    got = tn.anchored_turns(spark.createDataFrame(recordings, "id int, tokens array<string>"), spark.createDataFrame(turns, "id int, n int, marker int, first_words string, speaker string"), "id").collect()
    want = {(k, *x) for k, tokens in recordings if tokens for x in plain_turns(tokens, [t[1:] for t in turns if t[0] == k])}
    assert {(x["id"], x["n"], x["start"], x["end"], x["speaker"], x["found"]) for x in got} == want and len(got) == len(want)


def test_quotes(spark):
    raw = "[00:00:01] >> Well, I met Ben Lee Shapiro at the Daily Wire show, [00:01:00] and he said 'oh no' twice. Ben said hello to me there"
    cases = {
        "I met [SUBJECT] at the [AFFILIATION] and he said": (3, 16), "“and he said ‘oh no’ twice”": (14, 19), "met [SUBJECT] at the": (4, 9), "[SUBJECT] said hello to me": (20, 24), "Well I met": None, "met Ben ... he said oh no twice": (15, 19),
        "[SUBJECT] Well, I met Ben": None, "met [SUBJECT] the Daily": None, "he SAID oh no": (15, 18), "[SUBJECT] [COMPANY] [SUBJECT] [COMPANY]": None, "": None, "nothing like this here": None, "a (b [c d": None,
    }
    rows = spark.createDataFrame([(k, q) for k, q in enumerate(cases)], "k int, q string").select("k", tn.quote_span(F.lit(raw), F.col("q")).alias("s")).orderBy("k").collect()
    toks = raw.split()
    for (q, want), r in zip(cases.items(), rows, strict=True):
        assert (r["s"] and (r["s"]["first"], r["s"]["last"])) == want, (q, r["s"], r["s"] and toks[r["s"]["first"] : r["s"]["last"] + 1])
