"""Word selection of the toxicity operator under copies and rare words."""

import random

from pyspark.sql import functions as F

from tickerloom.llm.toxic_spans import ToxicTagger, score_toxicity

INSULTS = ["vile", "scummy", "grubby", "rotten", "nasty"]


def labelled_rows():
    """Label and text of 1,200 texts: common insults, one rarer than a twentieth of them, and 440 copies, some edited, of one toxic text."""
    draw = random.Random(3)
    plain = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(400)]
    rows = [(0, " ".join(draw.choices(plain, k=30))) for _ in range(800)]
    for i in range(400):
        insult = "uncommon" if i % 33 == 0 else INSULTS[0] if i % 3 else draw.choice(INSULTS)
        rows.append((1, " ".join([*draw.choices(plain, k=20), insult, *draw.choices(plain, k=9)])))
    copied = "odd copied phrases appear everywhere " + rows[-1][1]
    return rows + [(1, copied)] * 400 + [(1, f"{copied} {draw.choice(plain)} {draw.choice(plain)}") for _ in range(40)]


def test_copies_count_once_and_rare_insults_are_labelled(spark):
    rows = labelled_rows()
    tagger = ToxicTagger(spark.createDataFrame(rows, "label int, text string"))
    labelled = {w for w, toxic in tagger.candidates.items() if toxic}
    assert labelled == {*INSULTS, "uncommon"}
    assert tagger.score("some text with an uncommon word")[0] > tagger.score("some text with another word")[0]


def test_rare_insults_are_scored(spark):
    rows = [(i, label, text) for i, (label, text) in enumerate(labelled_rows())]
    frame = spark.createDataFrame(rows, "doc_id long, toxic int, text string")
    found = score_toxicity(frame.select("doc_id", "text"), frame.select("doc_id", "toxic")).where(F.size("starts") > 0)
    texts = {i: text for i, _, text in rows}
    words = {texts[r.doc_id][a:b] for r in found.collect() for a, b in zip(r.starts, r.ends)}
    assert words == {*INSULTS, "uncommon"}
