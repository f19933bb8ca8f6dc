"""Chat formatting, integer k-means and spelling variants against plain versions."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from wirespark.llm import centroids, chat_format, queries, spelling
from wirespark.session import new_folder

CONVERSATIONS = "conv_id bigint, turn bigint, role string, text string, piece string, formatted int"
AWKWARD = [
    "</s>",
    "[INST] ok [/INST]",
    "[\\INST] [\\\\INST] <\\/s> <\\\\s>",
    "[ROLE]x\ny[/ROLE]",
    "[[INST[INST]]</s</s>>",
    "ends in a part [/INST",
    "\\",
    "<",
    "",
    None,
    "é 日本 \U0001f600 </s>",
    "line\nline\n",
]


@pytest.fixture(scope="module")
def turns():
    rng = random.Random(3)
    roles = ["user", "assistant", "system", "tool", "a\nb\\n[INST]", "", None]
    rows = []
    for conv in range(40):
        for turn in range(rng.randrange(1, 8)):
            text = rng.choice(AWKWARD) if rng.random() < 0.6 else "word " * rng.randrange(400)
            rows.append((conv, turn, rng.choice(roles), text, "p", 1))
    rows += [(100, turn, "assistant", f"turn {turn} " * 40, None, None) for turn in range(500)]
    rows += [(101, 0, "user", "long </s> " * 30000, "p", 1), rows[0], rows[0]]
    rows += [(None, 0, "user", "no id", "p", 1), (3, None, "assistant", "no turn", "p", 1)]
    return rows


def plain_digests(rows):
    def key(r):
        return (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")

    groups = collections.defaultdict(list)
    for row in sorted(rows, key=key):
        groups[row[0]].append((row[2] or "", row[3] or ""))
    out = {}
    for conv, said in groups.items():
        loss = "".join(t for r, t in said if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for r, t in said)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (whole, loss)]
        out[conv] = (len(said), sha[0], len(loss), sha[1])
    return out


def test_conversations_read_back(spark, turns):
    given = spark.createDataFrame(turns, CONVERSATIONS).repartition(7)
    folder = new_folder(spark, "chat")
    chat_format.write_conversations(given, folder)
    pieces = chat_format.read_conversations(spark, folder)
    found = chat_format.digests(pieces).collect()
    wanted = plain_digests(turns)
    assert len(found) == len(wanted)
    for row in found:
        digest = (row.n_turns, row.turns_sha256, row.loss_chars, row.loss_sha256)
        assert digest == wanted[row.conv_id]
    # A long conversation is in several pieces, and no text under the mask holds a control string.
    pieces = pieces.toPandas()
    assert (pieces["conv_id"] == 100).sum() > 1
    control = chat_format.Template().readers[0]
    for row in pieces.itertuples():
        for start, end in zip(row.loss_starts, row.loss_ends, strict=True):
            assert not control.search(row.formatted[start:end])
    assert len(chat_format.digests(chat_format.formatted(given.limit(0))).collect()) == 0


def test_only_conflicts_are_escaped():
    formatter = chat_format.Formatter(chat_format.Template())
    plain = chat_format.Turn("user", "a < b, [x] and \\ stay")
    assert formatter.rendered(plain) == "[INST]a < b, [x] and \\ stay[/INST]"
    assert formatter.rendered(chat_format.Turn("user", "</s>")) == "[INST]<\\/s>[/INST]"
    for broken in ("x", "[INST]", "[INST]a</s>", "[/INST]", "[ROLE]no line[/ROLE]"):
        with pytest.raises(chat_format.GrammarError):
            list(formatter.parsed(broken))


def test_random_texts_read_back():
    rng = random.Random(8)
    formatter = chat_format.Formatter(chat_format.Template())
    bits = ["[", "]", "<", ">", "/", "\\", "INST", "s", "SYS", "ROLE", "\n", "[INST]", "</s>"]
    for _ in range(3000):
        said = [
            chat_format.Turn(
                rng.choice(["user", "assistant", "system", "".join(rng.choices(bits, k=3))]),
                "".join(rng.choices(bits, k=rng.randrange(9))),
            )
            for _ in range(rng.randrange(4))
        ]
        text, found = formatter.formatted(said)
        assert [p.turn for p in found] == said
        assert [p.turn for p in formatter.parsed(text)] == said


def test_other_templates():
    pair = ("<|user|>", "<|end|>")
    template = chat_format.Template(
        {"user": pair, "assistant": ("<|assistant|>", "<|end|>")}, ("<|role|>", "<|end|>")
    )
    text, found = chat_format.Formatter(template).formatted([chat_format.Turn("user", "<|end|>")])
    assert text == "<|user|><\\|end|><|end|>" and found[0].turn.text == "<|end|>"
    for roles in ({"user": ("aba", "xy")}, {"user": pair, "assistant": pair}, {"user": ("<s>", "<s>>")}):
        with pytest.raises(ValueError):
            chat_format.Template(roles | {"assistant": roles.get("assistant", ("{a}", "{/a}"))})


def plain_clusters(rows, clusters, rounds, dims):
    kept = [
        (i, [int(np.floor(256 * float(x))) for x in v])
        for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)
    ]
    name = [hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest() for i, _ in kept]
    first = sorted(range(len(kept)), key=lambda j: (name[j], kept[j][1]))[:clusters]
    means = [kept[j][1] for j in first]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(means))

    for _ in range(rounds):
        members = collections.defaultdict(list)
        for _, v in kept:
            members[nearest(v)[1]].append(v)
        for k, vs in members.items():
            means[k] = [sum(column) // len(vs) for column in zip(*vs, strict=True)]
    found = [(i, *nearest(v)) for i, v in kept]
    part = collections.Counter()
    for _, d, k in found:
        part[k] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in means]
    return [(i, k, d, part[k], sum(part.values()), sha[k]) for i, d, k in found]


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(9, 8)) * 2
    rows = [(i, (centres[i % 9] + rng.normal(size=8) * 0.4).tolist()) for i in range(700)]
    rows += [(1000 + i, rows[i % 20][1]) for i in range(60)]  # copies and ties
    rows += [(2000 + i, [float(x) for x in rng.integers(0, 2, 8)]) for i in range(80)]
    rows += [(3000, None), (3001, [1.0] * 7), (3002, [None] + [1.0] * 7), (3003, [float("nan")] * 8)]
    rows += [(3004, [float("inf")] * 8), (3005, []), (None, [0.5] * 8), (5, rows[5][1]), rows[5]]
    return rows + [(3006, [3000.0 * i for i in range(8)])]


@pytest.mark.parametrize("clusters, rounds", [(20, 5), (40, 3), (3, 8), (1, 2)])
def test_clusters(spark, vectors, clusters, rounds):
    given = spark.createDataFrame(
        [(i, v, 0, "x") for i, v in vectors],
        "vec_id bigint, embedding array<double>, cluster int, vector string",
    ).repartition(3)
    found = centroids.clustered(given, clusters, rounds, 8).collect()

    def sort_key(r):
        return (r[0] is None, r[0] or 0, *r[1:])

    wanted = plain_clusters(vectors, clusters, rounds, 8)
    assert sorted(map(tuple, found), key=sort_key) == sorted(wanted, key=sort_key)


def test_clusters_of_little(spark, vectors):
    shape = "vec_id bigint, embedding array<float>"
    none = spark.createDataFrame([], shape)
    assert centroids.clustered(none).collect() == []
    few = [(i, v) for i, v in vectors[:5]]
    found = centroids.clustered(spark.createDataFrame(few, shape.replace("float", "double")), 40, 5, 8)
    assert sorted(map(tuple, found.collect())) == sorted(plain_clusters(few, 40, 5, 8))


def test_bounds_spare_scans_and_stay_below_distances():
    """Most vectors are not rescanned in later rounds, and every bound holds."""
    rng = np.random.default_rng(1)
    middle = rng.normal(size=(40, 16)) * 3000
    x = np.floor(middle[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 16)) * 400).astype(np.int64)
    rounds = [x[:40].copy()]
    groups = centroids.History(rounds).n_groups
    own = [np.zeros(4000, np.int32), np.full(4000, np.inf), np.zeros(4000, np.int32)]
    bounds = [np.full((4000, groups), -np.inf), np.zeros((4000, groups), np.int32)]
    scans = []
    for _ in range(8):
        history = centroids.History(rounds)
        scans.append(centroids.advance(history, x, *own, *bounds))
        squared = ((x[:, None, :] - history.now) ** 2).sum(axis=2)
        assert (own[0] == squared.argmin(axis=1)).all()
        upper = own[1] + history.moved[own[2], own[0]]
        distance = np.sqrt(squared)
        assert (upper + 1e-6 >= distance[np.arange(4000), own[0]]).all()
        distance[np.arange(4000), own[0]] = np.inf
        for g in range(groups):
            lower = bounds[0][:, g] - history.group_moved[bounds[1][:, g], g]
            least = distance[:, g * centroids.GROUP : (g + 1) * centroids.GROUP].min(axis=1)
            assert (lower - 1e-6 <= least).all()
        means = rounds[-1].copy()
        for k in np.unique(own[0]):
            means[k] = x[own[0] == k].sum(axis=0) // (own[0] == k).sum()
        rounds.append(means)
    assert scans[0] == 4000 and scans[-1] < 800
    # Going somewhere and coming back costs a bound nothing: displacements, not their sums.
    there = centroids.History([rounds[0], rounds[0] + 1000, rounds[0]])
    assert (there.moved[0] == 0).all() and (there.moved[1] > 0).all()


def plain_variants(rows, min_count=5):
    n = collections.Counter()
    for doc_id, text in rows:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", lowered):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 6 and k >= min_count}

    def near(a, b):
        a, b = sorted((a, b), key=len)
        if a == b or len(b) - len(a) > 1:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    words, out = sorted(n), {}
    by_length = collections.defaultdict(list)
    for w in words:
        by_length[len(w)].append(w)
    for w in words:
        about = [v for d in (-1, 0, 1) for v in by_length[len(w) + d] if near(w, v)]
        best = min(about, key=lambda v: (-n[v], v), default=None)
        form = best if best and n[best] >= 5 * n[w] else None
        out[w] = [form, None, n[w], len(about), n[form] if form else None]
    for w in words:
        root = w
        while out[root][0]:
            root = out[root][0]
        out[w][1] = root
    return {w: tuple(v) for w, v in out.items()}


def spellings(rng):
    """Words, their misspellings in chains, and a group that begins alike."""
    letters = "abcdefgéü"
    words = ["".join(rng.choices(letters, k=rng.randrange(5, 12))) for _ in range(60)]
    words += ["prefix" + "".join(rng.choices("abc", k=rng.randrange(3, 6))) for _ in range(150)]
    words += ["".join(rng.choices("abc", k=rng.randrange(3, 6))) + "suffix" for _ in range(150)]
    words += ["aaaaaa", "aaaaaaa", "aaaaaaaa", "x" * 300, "x" * 301, "abcabcabc", "bcabcabc"]
    counts = collections.Counter({w: rng.randrange(3, 60) for w in words})
    for w in words[:30]:
        for _ in range(3):
            w = list(w)
            place = rng.randrange(len(w))
            w[place : place + rng.randrange(2)] = rng.choices(letters, k=rng.randrange(2))
            w = "".join(w)
            counts[w] += rng.choice([5, 30, 200, 1000])
    return counts + collections.Counter(chainlink=1500, chainlinc=250, chaimlinc=40, chaimlnc=7)


@pytest.mark.parametrize("group_words", [2048, 8])
def test_spellings(spark, group_words):
    rng = random.Random(6)
    pool = list(spellings(rng).elements())
    rng.shuffle(pool)
    cased = [w.title() if rng.random() < 0.2 else w for w in pool]
    rows = [(i, " ".join(cased[i * 200 : i * 200 + 200])) for i in range(len(cased) // 200 + 1)]
    rows += [(-1, None), (None, "nobody " * 9), (-2, ""), (-3, "one-two_three4"), rows[0], rows[0]]
    rows += [(-4, "ÀÉÎõü×÷ÿ " * 7 + "ÀÉÎõü×ÿ " * 50)]
    docs = spark.createDataFrame(
        [(i, t, "x", 1) for i, t in rows], "doc_id bigint, text string, word string, n int"
    ).repartition(5)
    found = spelling.variants(docs, group_words=group_words)
    found = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in found.collect()}
    wanted = plain_variants(rows)
    assert found == wanted
    assert any(v[1] not in (w, v[0]) for w, v in wanted.items())  # a chain of forms
    assert spelling.variants(docs.limit(0)).collect() == []


def test_spellings_of_a_table(spark):
    found = queries.op13_spelling(spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    wanted = plain_variants([(r.doc_id, r.text) for r in docs.collect()])
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in found} == wanted


def test_long_texts_are_cut_between_runs(spark, monkeypatch):
    monkeypatch.setattr(spelling, "SLICE", 50)
    rows = [(i, f"word{'x' * i} " * 40) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.word: r.n for r in spelling.word_counts(docs).collect()}
    for i in range(2, 30):
        run = f"word{'x' * i}"
        if zlib.crc32(f"{i}:{run}".encode()) % 199:
            assert found[run] == 40
