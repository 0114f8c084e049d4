import random

import pytest

from tasteloom.llm import licenses


def quotes(seed):
    """``(doc_id, label, text)``: every long template with 1 of 25 words replaced, amid others."""
    draw = random.Random(seed)
    made = []
    for template in licenses.TEMPLATES:
        if template.base or len(template.words()) < 25:
            continue
        for _ in range(4):
            words = template.words()
            for at in draw.sample(range(len(words)), len(words) // 25):
                words[at] = f"other{at}"
            around = [f"w{draw.randrange(5000)}" for _ in range(60)]
            made.append((len(made), template.label, " ".join(around[:30] + words + around[30:])))
    return made


def test_recall_of_mutated_quotes_and_silence_on_shuffled_words(spark):
    made = quotes(11)
    draw = random.Random(5)
    mixed = []
    for i, _, text in made:
        words = text.split(" ")
        draw.shuffle(words)
        mixed.append((10_000 + i, " ".join(words)))
    docs = spark.createDataFrame([(i, t) for i, _, t in made] + mixed, "doc_id long, text string")
    found = {r["doc_id"]: r["labels"].split(",") for r in licenses.scan(docs).collect()}
    hit = [label in found[i] for i, label, _ in made]
    assert len(hit) >= 60 and sum(hit) >= 0.95 * len(hit)
    assert all(found[i] == [""] for i, _ in mixed)


def test_licenses_of_one_family_are_told_apart(spark):
    texts = {t.label: t.text for t in licenses.TEMPLATES}
    table = [
        (1, texts["cc-by-sa"]),
        (2, texts["cc-by"]),
        (3, texts["lgpl-notice"]),
        (4, texts["bsd-2-clause"] + " " + texts["bsd-3-clause"] + "\n" + texts["bsd-disclaimer"]),
        (5, texts["bsd-text"]),
        (6, texts["mit-text"] + "\n\n" + texts["mit-disclaimer"]),
    ]
    docs = spark.createDataFrame(table, "doc_id long, text string")
    found = {r["doc_id"]: r["labels"] for r in licenses.scan(docs).collect()}
    assert found == {
        1: "cc-by-sa",
        2: "cc-by",
        3: "gpl,lgpl-notice",
        4: "bsd-2-clause,bsd-3-clause,bsd-disclaimer,bsd-text",
        5: "bsd-text",
        6: "mit-disclaimer,mit-text",
    }


def test_templates_from_a_folder(spark, tmp_path):
    (tmp_path / "house-1.0.txt").write_text("You may\nread this, once, on rainy days only. Ever.")
    (tmp_path / "other").write_text("No copies without a written permission of the owner")
    templates = licenses.read_templates(spark, str(tmp_path))
    assert [(t.label, len(t.words())) for t in templates] == [("house-1.0", 10), ("other", 9)]
    docs = spark.createDataFrame([(1, "x you MAY read this once on rainy days only ever y")], "doc_id long, text string")
    assert licenses.scan(docs, templates).first()["labels"] == "house-1.0"
    (tmp_path / "short.txt").write_text("one")
    with pytest.raises(ValueError, match="short"):
        licenses.read_templates(spark, str(tmp_path))
