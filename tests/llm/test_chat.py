import hashlib
import random
from collections import Counter, defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from foldwise.llm import chat, registry

ODD = st.text(st.sampled_from("\\#</turn> :\nab###é"), max_size=20)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.tuples(ODD, ODD), max_size=5))
def test_format_is_reversible(turns):
    assert chat.parse("".join(chat.format_turn(r, t)[0] for r, t in turns)) == turns
    for r, t in turns:
        s, a, b = chat.format_turn(r, t)
        assert chat.unescape(s[a:b]) == t and "###" not in s[a:b] and "</turn>" not in s[a:b]


def test_cut_respects_budget_and_covers_all():
    rnd = random.Random(1)
    for _ in range(400):
        sizes = [rnd.randint(0, 60) for _ in range(rnd.randint(1, 30))]
        system = rnd.choice([0, 10])
        ws = chat.cut(sizes, system, [False] * len(sizes), 100, 30)
        assert [i for _, a, b in ws for i in range(a, b)] == list(range(len(sizes)))
        for k, (back, a, b) in enumerate(ws):
            assert sum(sizes[back:b]) + system <= 100 or b - a == 1
            assert sum(sizes[back:a]) <= 30 and back >= (ws[k - 1][1] if k else a)


def digests(rows):
    by = defaultdict(list)
    for c, t, r, x in rows:
        by[c].append((t is not None, t or 0, r or "", x or ""))
    out = {}
    for c, ts in by.items():
        ts.sort()
        loss = "".join(x for _, _, r, x in ts if r == "assistant")
        out[c] = (len(ts), hashlib.sha256("".join(f"{r}\n{x}\n" for _, _, r, x in ts).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_windows_read_back(spark):
    rnd = random.Random(7)
    word = lambda: rnd.choice(["the", "###", "</turn>", "\\", "ü", "and\n", "tion", ":"])
    rows = []
    for c in range(12):
        if c % 3 == 0:
            rows.append((c, 0, "system", "be kind " * 5))
        rows += [(c, k + 1, rnd.choice(["user", "assistant"]), " ".join(word() for _ in range(rnd.randint(0, 60)))) for k in range(rnd.randint(1, 40))]
    rows += [(None, 1, "user", "hi"), (None, None, "assistant", None), (77, 1, None, None), (77, 1, None, None), (78, 1, "assistant", "long " * 30_000), (78, 2, "assistant", "x")]
    rows += [(500, k, ["user", "assistant"][k % 2], f"turn {k} " + "filler " * 20) for k in range(1500)]  # one large conversation
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, n_tokens int").repartition(5)
    win = chat.windows(df, budget=200, history=50)
    out = chat.read_back(win).collect()
    want = digests(rows)
    assert len(out) == len(want)
    for r in out:
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == want[r.conv_id]
    ws = win.collect()
    assert Counter(w.conv_id for w in ws) == {r.conv_id: r.n_windows for r in out}
    assert sum(len(w.text) for w in ws) == sum(r.formatted_chars for r in out)
    for w in ws:
        assert w.n_tokens <= 200 or w.n_new == 1
        turns = chat.parse(w.text)
        assert len(turns) == w.n_system + w.n_repeated + w.n_new and (not w.n_system or turns[0][0] == "system")
        assert len(w.loss) == sum(r == "assistant" for r, _ in turns[w.n_system + w.n_repeated:])
    assert any(w.n_repeated for w in ws) and any(w.n_system for w in ws) and len([w for w in ws if w.conv_id == 500]) > 100
    assert chat.windows(df.limit(0)).count() == 0


def test_op1_query(spark, sf):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()]
    rows += [(-7, 0, "user", chat.CONTROL), (-7, 1, "assistant", chat.CONTROL)]
    out = registry.QUERIES["op1_chat_windows"](spark, sf).collect()
    want = digests(rows)
    assert len(out) == len(want) and all((r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == want[r.conv_id] for r in out)
    assert all(r.formatted_chars >= sum(len(x or "") for c, _, _, x in rows if c == r.conv_id) for r in out)
