import random
import re
from collections import Counter

from emberlog.llm import line_rules
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    runs = {}
    for i in range(len(words) - 7):
        runs.setdefault(tuple(words[i:i + 8]), []).append(i)
    covered = {i + k for places in runs.values() if len(places) > 1 for i in places for k in range(8)}
    seen, duplicates = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            duplicates += line in seen
            seen.add(line)
    n = len(words)
    failed = n < 20 or 100 * len(covered) > 30 * n
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), duplicates, len(covered), failed


def digest(spark, texts):
    rows = [(i, t) for i, t in enumerate(texts)]
    out = line_rules.clean_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(out) == len(rows)
    return {r.doc_id: r for r in out}


def test_base_equals_brute_force(spark):
    rng = random.Random(1)
    texts = ["", None, " \n\t", "word", "é # * < > x y \x0b z", "a\r\nb\r\na\r\n"]
    for _ in range(200):
        words = [rng.choice(["a", "b", "é", "#x", "yy", "|"]) for _ in range(rng.randint(0, 12))]
        texts.append("".join(rng.choice(words or ["z"]) + rng.choice([" ", "\n", "  ", "\t", "\n "]) for _ in range(rng.randint(0, 80))))
    got = digest(spark, texts)
    for i, text in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(text)
        assert not (r.base_failed and r.kept)


PROSE = "\n".join(f"Line {i} of it{i} says something{i} of its{i} own{i}, as prose{i} does." for i in range(12))


def test_rules_per_line(spark):
    menu = "Home | News | Sport | Contact"
    got = digest(spark, [
        PROSE, f"{menu}\n{PROSE}\nWe use it under our cookie policy and privacy policy.", "\n".join([f"Home{i} | News{i} | Sport{i} | Contact{i}" for i in range(30)]),
        "\n".join(f"WIN{i}!! NOW{i}!! CLICK{i}!! HERE{i}!! {i * 7}!! TODAY!!" for i in range(10))])
    assert got[0].kept and got[0].clean_text == PROSE and got[0].n_lost_words == 0
    assert got[1].kept and got[1].clean_text == PROSE
    assert (got[1].n_navigation_lines, got[1].n_boilerplate_lines) == (1, 1)
    assert not got[2].kept and not got[3].kept
    assert got[3].n_punctuation_lines == 10 and got[3].clean_text == ""


def test_extra_columns_empty_table_and_repeats(spark):
    docs = spark.createDataFrame([(1, PROSE, True), (1, PROSE, False), (None, PROSE, True)], "doc_id long, text string, kept boolean")
    rows = line_rules.clean_lines(docs, with_text=False).collect()
    assert len(rows) == 3 and len({tuple(r)[1:] for r in rows}) == 1
    assert line_rules.clean_lines(docs.where("false")).count() == 0


def test_long_text(spark):
    text = " ".join(f"word{i}." for i in range(300_000))
    assert digest(spark, [text])[0].n_words == 300_000


def brute_recurring(texts, least=10, max_share=10):
    beside = {}
    for text in set(texts):
        pairs = set()
        lines = [line.strip(" \t\n\x0b\x0c\r") for line in (text or "").split("\n") if WORD.search(line)]
        for i, line in enumerate(lines):
            if 4 <= len(WORD.findall(line)) <= 40:
                for side, k in ((0, i - 1), (1, i + 1)):
                    if 0 <= k < len(lines):
                        pairs.add((line, side, lines[k]))
        for line, side, other in pairs:
            beside.setdefault((line, side), Counter())[other] += 1
    return {line for (line, _), c in beside.items() if c.total() >= least and 100 * max(c.values()) <= max_share * c.total()}


def test_recurring_lines_equal_brute_force(spark):
    rng = random.Random(3)
    stock = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(30)]
    texts = [None, "", "\n \n"]
    for i in range(300):
        texts.append("\n".join(rng.choice(["", " ", "\t"]) + (rng.choice(stock) if rng.random() < 0.3 else f"own line number {i} {k}")
                               for k in range(rng.randint(0, 9))))
    texts += texts[5:25] * 3
    frame = spark.createDataFrame([(t or "",) for t in texts], "text string").withColumn("key", F.xxhash64("text"))
    for least, share in ((10, 10), (3, 40), (1, 100)):
        got = {r.line for r in line_rules.recurring_lines(frame, "key", least=least, max_share=share).collect()}
        assert got == {line_rules.line_hash(line) for line in brute_recurring(texts, least, share)}
    assert got


def test_lines_in_changing_surroundings_go_and_copies_stay(spark):
    own = [[f"Zeile {i} {k} sagt etwas Eigenes {i * 31 + k} dazu, wie es Prosa{i}x{k} eben tut." for k in range(6)] for i in range(30)]
    stamp = "Alle Rechte an diesem Werk bleiben beim Verlag."
    texts = ["\n".join([*lines[:3], stamp, *lines[3:]]) for lines in own]
    # Near copies: one line differs in each, the rest stands beside the same lines.
    base = [f"Line{k} of{k} the{k} copied{k} text{k} says{k} what it says." for k in range(12)]
    near = ["\n".join([*base[:i % 12], f"changed line number {i} in this copy only.", *base[i % 12 + 1:]]) for i in range(60)]
    got = digest(spark, [*texts, *near, *[texts[0]] * 50])
    for i, lines in enumerate(own):
        assert got[i].kept and got[i].clean_text == "\n".join(lines)
        assert (got[i].n_boilerplate_lines, got[i].n_recurring_lines) == (1, 1)
    for i, text in enumerate(near):
        assert got[30 + i].kept and got[30 + i].clean_text == text
    assert got[95].clean_text == got[0].clean_text


def brute_kept(text, known, max_lost=0.5):
    """The verdict by its definition: words of failing lines against all words."""
    n, *_, failed = brute(text)
    lost = 0
    for line in (text or "").split("\n"):
        words = WORD.findall(line)
        if words and (line_rules.line_fault(line, words) or (4 <= len(words) <= 40 and line.strip(" \t\r") in known)):
            lost += len(words)
    return not failed and lost <= max_lost * n, lost


def test_kept_equals_brute_force(spark):
    rng = random.Random(5)
    stock = ["this line is found all over", "we use them under our privacy policy", "$ # % &",
             *[f"Home{j} | News{j} | Sport" for j in range(12)]]
    texts = ["\n".join(rng.choice(stock) if rng.random() < 0.55 else f"own{i} words{i} of{k} line{k} {i * k}" for k in range(12)) for i in range(150)]
    got, known = digest(spark, texts), brute_recurring(texts)
    assert stock[0] in known
    for i, text in enumerate(texts):
        assert (got[i].kept, got[i].n_lost_words) == brute_kept(text, known)
    assert 0 < sum(r.kept for r in got.values()) < len(texts)
