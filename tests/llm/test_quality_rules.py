import random
import re

from cardloom.llm import quality_rules as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    t = text or ""
    words = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, g in enumerate(windows) if windows.count(g) > 1 for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), sum(x in lines[:i] for i, x in enumerate(lines)), len(covered)


def test_measures_against_brute_force(docs):
    random.seed(5)
    texts = [None, "", " \n\t", "a", "a b", "a b c", "a b c a b c", "x\ny\nx\n\n \n", "é 😀|#\r\nb", "a " * 500]
    texts += ["".join(random.choice(["a", "b", "c", " ", "\n", "\v", "|", "é"]) for _ in range(random.choice([5, 30, 120]))) for _ in range(60)]
    got = {r.doc_id: r for r in q.judge(docs(texts)).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(t), repr(t)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)


def test_good_text_stays_with_its_own_columns(spark, docs):
    good = " ".join(f"the w{i} of" for i in range(40))
    junk = " | ".join(f"w{i}" for i in range(90))
    df = docs([good, junk, None, good]).withColumnRenamed("n_chars", "n_words").withColumnRenamed("source", "kept")
    out = q.keep_good(df)
    assert out.columns == df.columns and sorted(r.doc_id for r in out.collect()) == [0, 3]
    assert q.keep_good(df.limit(0)).count() == 0


def test_table_is_a_parameter(docs):
    never = (q.Threshold("n_words", most=-1),)
    assert q.judge(docs(["the of " * 100]), thresholds=never, base=()).first().kept is False


def test_very_long_texts_thresholds_and_stop_words(docs):
    text = " ".join(f"der w{i}" for i in range(60))
    long = " ".join(f"w{i % 70_000} the" for i in range(100_000))
    got = {r.doc_id: r for r in q.judge(docs([text, long]), stop_words=["xyz"]).collect()}
    assert got[0].stop_word_ratio == 0 and not got[0].kept and got[1].n_words == 200_000 and got[1].n_repeat_words == brute_repeats(long)
    assert q.judge(docs([text]), stop_words=["der"]).first().kept
    edge = " ".join(["the", *[f"w{i}" for i in range(49)]])
    assert q.judge(docs([edge])).first().kept  # 50 words, a fiftieth of them stop words


def brute_repeats(text):
    words = text.split()
    seen = {}
    for i in range(len(words) - 2):
        seen.setdefault(tuple(words[i : i + 3]), []).append(i)
    return len({i + k for at in seen.values() if len(at) > 1 for i in at for k in range(3)})
