"""Every operator against a brute-force version, on a small corpus of hard cases."""

import hashlib
import io
import itertools
import os
import random
import re
import time
import wave
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from geolith.llm import components, exact_dedup, kernels, license_rules, license_scan, media_chunks, mixing, near_dedup, packing, quality, secret_scan, subwords, token_output, toxicity
from geolith.llm.shared import Scratch, scratch_scope


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def same_rows(a, b):
    key = lambda rows: Counter(tuple(r) for r in rows)
    assert key(a) == key(b)


# ---- exact dedup


def test_exact_dedup(spark, corpus):
    got = exact_dedup.exact_dedup(corpus, exact_dedup.DigestIndex(spark, Scratch(spark, "t").path("i"))).collect()
    digest = lambda t: hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", t or "").encode()).hexdigest()
    groups = defaultdict(list)
    for r in corpus.collect():
        groups[digest(r["text"])].append(r["doc_id"])
    want = []
    for d, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        want += [(i, keep, len(ids), i == keep if keep is not None else i is None, d) for i in ids]
    found = [(r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in got]
    same_rows([w for w in want if w[1] is not None], [f for f in found if f[1] is not None])
    assert len(found) == len(want)


def test_exact_dedup_over_batches(spark, corpus):
    path = Scratch(spark, "t").path("i")
    first = exact_dedup.exact_dedup(corpus.filter("doc_id < 50"), exact_dedup.DigestIndex(spark, path)).filter("kept").select("doc_id").distinct().count()
    again = exact_dedup.exact_dedup(corpus.filter("doc_id >= 50"), exact_dedup.DigestIndex(spark, path))
    seen = again.filter("NOT kept AND keep_id < 50").count()
    assert first == 50 and seen >= 40
    assert exact_dedup.DigestIndex(spark, path).rows().count() == exact_dedup.DigestIndex(spark, path).rows().select("digest").distinct().count()


def test_an_index_keeps_its_buckets(spark, corpus):
    path = Scratch(spark, "t").path("i")
    exact_dedup.exact_dedup(corpus, exact_dedup.DigestIndex(spark, path, 3)).count()
    index = exact_dedup.DigestIndex(spark, path, 9)
    spark.sql(f"DROP TABLE {index.name}")  # as a new session finds it: the rows stay
    again = exact_dedup.DigestIndex(spark, path, 9)
    held = again.rows().count()
    exact_dedup.exact_dedup(corpus, again)
    assert again.buckets == 3 and again.rows().count() == held == again.rows().select("digest").distinct().count()


def test_a_compacted_index_has_one_file_a_bucket(spark, corpus):
    path = Scratch(spark, "t").path("i")
    index = exact_dedup.DigestIndex(spark, path, 2)
    for part in ("doc_id < 40", "doc_id >= 40 AND doc_id < 80", "doc_id >= 80"):
        exact_dedup.exact_dedup(corpus.filter(part), index)
    before = sorted(map(tuple, index.rows().collect()))
    assert index.rows().select(F.input_file_name()).distinct().count() > 2
    index.compact()
    for again in (index, exact_dedup.DigestIndex(spark, path)):
        assert sorted(map(tuple, again.rows().collect())) == before and again.buckets == 2
        assert again.rows().select(F.input_file_name()).distinct().count() == 2
    assert exact_dedup.exact_dedup(corpus.filter("doc_id >= 80"), exact_dedup.DigestIndex(spark, path)).count() == corpus.filter("doc_id >= 80").count()


def test_scratch_goes_with_its_scope(spark, corpus):
    folder = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(folder))
    with scratch_scope():
        near_dedup.near_components(corpus).count()
        inside = set(os.listdir(folder))
    assert inside > before and set(os.listdir(folder)) == before


def test_drop_exact_copies_keeps_columns(spark, corpus):
    kept = exact_dedup.drop_exact_copies(spark, corpus)
    assert kept.columns == corpus.columns
    texts = [re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or "") for r in kept.collect()]
    assert len(texts) == len(set(texts))


# ---- quality, toxicity


def labelled(spark):
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcdefghij"), 5)) for _ in range(300)]
    rows, labels = [], []
    for k in range(240):
        w = list(rng.choice(words, 60))
        junk, toxic = k % 4 == 0, k % 3 == 0
        if toxic:
            w[int(rng.integers(60))] = ["vileword", "vilest"][k % 2]
        text = " ".join(f"{x}%%%" if junk else x + ("." if j % 12 == 11 else "") for j, x in enumerate(w))
        rows.append((k, text))
        labels.append((k, int(not junk), int(toxic)))
    return spark.createDataFrame(rows, "doc_id BIGINT, text STRING"), spark.createDataFrame(labels, "doc_id BIGINT, quality INT, toxic INT")


def test_quality_learns_what_is_held_out(spark):
    docs, labels = labelled(spark)
    settings = subwords.Settings(bits=14, dim=6)
    table = quality.quality_model(docs, labels, settings)
    got = quality.with_scores(docs, table, settings).join(labels, "doc_id").filter(quality.held_out(F.col("doc_id"))).toPandas()
    assert len(got) > 50 and ((got["score"] >= 0.5) == (got["quality"] == 1)).mean() > 0.95
    kept = quality.keep_quality(spark, docs, labels, settings)
    assert kept.columns == docs.columns and 150 < kept.count() < 200


FULL = (1 << 64) - 1


def mixed(h):
    for _ in range(2):
        h = ((h ^ (h >> 32)) * 0xD6E8FEB86659FD93) & FULL
    return h ^ (h >> 32)


def raw_hash(data):
    return sum(int(kernels._BYTE[b]) * pow(0x9E3779B97F4A7C15, i, 1 << 64) for i, b in enumerate(data)) & FULL


HARD = ["", "a", "two words", "the cat sat. The CAT ran away! Is it a toxicword?\n\rÉß 日本 end", "x " * 90, "\t\n", "No.no?NO!! the the"]


def test_scores_are_softmax_of_mean_feature_vectors():
    settings = subwords.Settings(bits=10)
    table = np.random.default_rng(1).normal(size=(1 << 10, 3)) * 5
    got = subwords.class_scores([t.encode() for t in HARD], table, settings)
    for text, row in zip(HARD, got, strict=True):
        data = text.encode()
        words = [mixed(raw_hash(w)) for w in re.findall(rb"[^\x20\x09-\x0D]+", data)]
        found = [*words, *(mixed((3 * b - 3 * a + 0x5851F42D4C957F2D) & FULL) for a, b in zip(words, words[1:]))]
        found += [mixed((raw_hash(data[k : k + n]) + n) & FULL) for n in settings.ngrams for k in range(len(data) - n + 1)]
        z = sum((table[h >> 54] for h in found), np.zeros(3)) / max(len(found), 1)
        assert row == pytest.approx(np.exp(z) / np.exp(z).sum())


def test_toxicity_is_the_brute_force_noisy_or():
    settings = toxicity.Settings(bits=10)
    weights = np.random.default_rng(2).normal(size=1 << 10) * 2
    texts = [t.encode() for t in HARD]
    s = toxicity.Sentences(texts, settings)
    got = -np.expm1(kernels.segment_sums(toxicity._log_clean(s.logits(weights, -1.5)), s.lo, s.hi))
    for data, score in zip(texts, got, strict=True):
        clean = 1.0
        for sentence in re.split(rb"[\n\r!.?]", data.lower()):
            words = re.findall(rb"[0-9A-Za-z\x80-\xff]+", sentence)
            hashes = {mixed(raw_hash(w)) for w in words} | {(mixed(raw_hash(w[:n])) + n) & FULL for w in words for n in settings.prefixes if len(w) > n}
            if words:
                z = -1.5 + sum(weights[b] for b in {(h * 0x9E3779B97F4A7C15 & FULL) >> 54 for h in hashes})
                clean *= 1 - 1 / (1 + np.exp(-z))
        assert score == pytest.approx(1 - clean)


def test_what_teaches_is_bounded(spark):
    docs = spark.range(40).selectExpr("id % 4 AS doc_id", "concat('word', id) AS text").union(spark.range(3000).selectExpr("7 AS doc_id", "concat('again ', id) AS text")).union(spark.sql("SELECT 8, repeat('long ', 10000000)")).union(spark.sql("SELECT 9, NULL"))
    chosen = spark.createDataFrame([(k, k % 2) for k in range(12)], "doc_id BIGINT, label INT")
    rows = {r["doc_id"]: r["text"] for r in subwords.teaching(docs, chosen, 1 << 24).collect()}
    assert set(rows) == {0, 1, 2, 3, 7, 9} and rows[9] == "" and len(rows[7]) == 7
    assert subwords.teaching(docs, chosen, 64 * 12).agg(F.sum(F.octet_length("text"))).first()[0] <= 2 * 64 * 12
    features = subwords.Features([b" ".join(b"w%d" % k for k in range(5000))], subwords.Settings())
    assert features.counts(0)[1].sum() == features.n[0]  # all of a text teaches


def test_quality_of_hard_texts(spark, corpus, empty):
    docs, labels = labelled(spark)
    table = quality.quality_model(docs, labels)
    got = quality.with_scores(corpus, table)
    rows = got.collect()
    assert len(rows) == corpus.count() and all(0 <= r["score"] <= 1 for r in rows)
    same = defaultdict(set)
    for r, t in zip(sorted((r for r in rows if r["doc_id"] is not None), key=lambda r: r["doc_id"]), sorted((r for r in corpus.collect() if r["doc_id"] is not None), key=lambda r: r["doc_id"]), strict=True):
        same[t["text"] or ""].add(r["score"])
    assert all(len(s) == 1 for s in same.values())
    assert quality.with_scores(empty, table).count() == 0
    nothing = quality.quality_model(docs, labels.filter("false"))
    assert {r["score"] for r in quality.with_scores(docs, nothing).collect()} == {0.5}
    assert quality.keep_quality(spark, corpus, labels).schema == corpus.schema


def test_labels_with_nulls_and_repeats(spark):
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, None), (None, 1), (3, 0)], "doc_id BIGINT, label INT")
    assert sorted(map(tuple, subwords.sampled(labels, 2, 10).collect())) == [(1, 1), (3, 0)]


def test_toxicity_finds_the_sentence(spark):
    docs, labels = labelled(spark)
    settings = toxicity.Settings(bits=14)
    model = toxicity.toxicity_model(docs, labels.filter(~toxicity.held_out(F.col("doc_id"))), settings)
    got = toxicity.with_toxicity(docs, model, settings).join(labels, "doc_id").join(docs, "doc_id").filter(toxicity.held_out(F.col("doc_id"))).toPandas()
    assert ((got["score"] >= 0.5) == (got["toxic"] == 1)).mean() > 0.95
    bad = got[(got["toxic"] == 1) & (got["score"] >= 0.5)]
    assert len(bad) and all("vile" in t[a:b] for t, a, b in zip(bad["text"], bad["worst_start"].astype(int), bad["worst_end"].astype(int)))


def test_toxicity_is_the_noisy_or_of_sentences(spark, corpus, empty):
    weights = np.zeros(1 << 18)
    weights[::7] = 0.8
    rows = toxicity.with_toxicity(corpus, (weights, -3.0)).collect()
    assert len(rows) == corpus.count() and toxicity.with_toxicity(empty, (weights, -3.0)).count() == 0
    for r in rows:
        assert 0 <= r["score"] <= 1 and (r["n_sentences"] > 0) == (r["worst_start"] is not None)
        if r["n_sentences"] == 0:
            assert r["score"] == 0
    s = toxicity.Sentences([b"One two. Two two three!\nFour", b"", b"x"], toxicity.Settings())
    assert (s.hi - s.lo).tolist() == [3, 0, 1]
    alone = [toxicity.Sentences([t], toxicity.Settings()).logits(weights, -1.0).tolist() for t in (b"Two two three", b"three two")]
    assert alone[0] == pytest.approx(alone[1])  # repeated words count once


def test_toxicity_without_labels(spark, corpus):
    docs, labels = labelled(spark)
    model = toxicity.toxicity_model(docs, labels.filter("toxic = 0"))
    assert not model[0].any()


# ---- secrets


def base_secrets(text):
    spans = [(m.start(), 0, m.end()) for m in re.finditer(r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 8]
    spans += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    return sorted(spans + [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32])


SECRETS = [
    "password=abcdefgh12345678 Token: short api_key : 'aG7xPq92LmZt'", "AKIA" + "A1" * 8 + " xAKIAB " + "0af" * 12, "é API_KEY=\"x/y+z==aaaa\" " + "a" * 31 + " " + "b" * 33,
    "DEFAULT = 'aG7xPq92LmZt'\nclient_secret_value = DEFAULT\nname = 'bob'", "x: 1\ny = z\nz = y\n" * 50, "=" * 2000, "a" * 5000 + "=" + "b" * 5000, None, "",
]


def test_secrets(spark, corpus, empty):
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(SECRETS)], "doc_id BIGINT, text STRING").unionByName(corpus.select("doc_id", "text").filter("doc_id >= 100"))
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    for r in secret_scan.scan_secrets(docs).collect():
        base = base_secrets(texts[r["doc_id"]])
        line = ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert r["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == j for _, k, _ in base) for j in range(3)]
        assert set(filter(None, line.split(","))) <= set(r["spans"].split(","))
    assert secret_scan.scan_secrets(empty).count() == 0


def test_constants_are_followed():
    text = 'KEY_A = "aG7xPq92LmZt"\nk2 = KEY_A\npassword = k2\nother = "qLm2KdZx81-P"\nDB_PWD=$THERE\nTHERE=9xKq72LmPw31\n'
    assert [(text[a:b], n) for a, b, _, n in secret_scan.assigned_literals(text)] == [("aG7xPq92LmZt", "password"), ("9xKq72LmPw31", "DB_PWD")]
    assert secret_scan.assigned_literals('password = "changeme"\nsecret = "example"\n') == []


@pytest.mark.parametrize("line", [
    'password: str = "V"', 'const token: string = "V"', 'db_pwd: Optional[str] = "V"', 'api_key: dict[str, list[int]] | None = "V"', "let token: &'static str = \"V\";", 'var token string = "V"', 'const char *password = "V";',
    'os.environ["DB_PASSWORD"] = "V"', 'cfg["client_secret"]="V"', 'os.environ.setdefault("DB_PASSWORD", "V")', 'setenv("DB_PASSWORD", "V")', "define('DB_PASSWORD', 'V');", 'connect(host, password="V")',
    'private_key = (\n "V"\n)', "auth_token: str = (  # a note\n    'V')", 'password = \\\n  "V"', 'passphrase:\n  "V"', 'client_secret = ["short", "V"]', 'password = "\""V"\""', 'password = "\""\nV\n"\""', 'password = b"V"', "password=`V`",
    '<password>V</password>', '<add key="db_password" value="V"/>', '<entry key="db_password"> V </entry>', 'db_password: |\n  V\nother: x', '{"client": {"secret": "V"}}', 'password => "V"', 'password <- "V"', 'password ||= "V"', 'a = b = password = "V"',
    '#define DB_PASSWORD "V"', '#define DB_PASSWORD V', 'export DB_PASSWORD=V', 'ENV DB_PASSWORD V', 'curl --password V', 'DB_PASSWORD=${OTHER:-V}', 'http://h/p?db_pwd=V&x=1', 'Authorization: Bearer V',
    '# password = "V"', '/* password = "V" */', '<!-- password: V -->', 'x = "pwd=V;a=b"', 'password = x or "V"', 'password = os.getenv("NOPE", "V")', 'password = found ? "V" : "none"', 'A = "V"\npassword = f(A)', "password: 'V' # c", "p" * 139 + '_password = "V"',
])
def test_assignments_of_many_forms(line):
    line = line.replace("ENV ", "\0").replace("V", "S3cr3t-q4lue-99").replace("\0", "ENV ")
    assert [line[a:b] for a, b, *_ in secret_scan.assigned_literals(line)] == ["S3cr3t-q4lue-99"]


def test_joined_literals_are_one():
    for line in ('password = "S3cr3t-" + "V4lue-99"', "password = ('S3cr3t-'\n  'V4lue-99')", '$password = "S3cr3t-" . "V4lue-99";'):
        [(a, b, *_)] = secret_scan.assigned_literals(line)
        assert line[a:].startswith("S3cr3t-") and line[:b].endswith("V4lue-99")


def test_what_is_no_secret():
    for line in ('secret = config.get("client_secret_key")', 'token = user_of("alice_of_wonder")', "It's a secret: don't tell; the key (it's old) is here.", 'auth:\n  "aG7xPq92LmZt": "x"\n', 'password = os.environ["DB_PASSWORD_9"]'):
        assert secret_scan.assigned_literals(line) == []


@pytest.mark.parametrize("seed", range(30))
def test_literals_reach_names_as_in_a_closure(seed):
    rng = random.Random(seed)
    names = [*(f"v{k}" for k in range(12)), "db_password", "my_pin", "auth_token", "cookie"]
    flows, literals, lines = set(), {}, []
    for k in range(25):
        a, b = rng.choice(names), rng.choice(names)
        if rng.random() < 0.3:
            literals[a] = literals.get(a, []) + [f"aG7xPq92Lm{k:02d}"]
            lines.append(rng.choice(['{} = "{}"', "{}: {}", "export {}={}"]).format(a, literals[a][-1]))
        else:
            flows.add((b, a))
            lines.append(rng.choice(["{} = {}", "{}=${}", "{} := f({})", '{} = "${{{}}}"']).format(a, b))
    reach = {n: {n} for n in names}
    for _ in names:
        for b, a in flows:
            reach[b] |= reach[a]
    rng.shuffle(lines)
    text = "\n".join(lines)
    want = {v: max(secret_scan.name_score(t) for t in reach[n]) * secret_scan.literal_score(v) for n, vs in literals.items() for v in vs}
    want = {v: s for v, s in want.items() if s >= secret_scan.REPORT}
    assert {text[a:b]: s for a, b, s, _ in secret_scan.assigned_literals(text)} == pytest.approx(want)


@pytest.mark.parametrize("text", [
    "".join(f"a{k} = hub\nhub = a{k}\n" for k in range(12000)) + "password=hub", "password='" + "\\'" * 100000, "password = " + "(" * 200000, "password=1 /*" * 30000, "<password>" * 40000, "key: b[]|" * 50000 + " x",
    *(m * (1_000_000 // len(m)) + "\npassword = 'aG7xPq92LmZt'" for m in ("#", "# ", "//", "// # ", "<!-- ", "/*", "/* # // ", "# = ", "// \"= ", "# '= ", "#\"'=`")),
    "a-" * 150000 + "key=", "--aaaa " * 50000 + "key=", "${a:-" * 60000 + "key=", "key: |\n" * 50000, "<key " + 'a="b" ' * 60000 + ">", "password =" + " " * 300000 + "x", "#define " * 50000 + "key",
])
def test_lexing_is_linear(text):
    began = time.process_time()
    secret_scan.assigned_literals(text)
    assert time.process_time() - began < (6 if len(text) < 900_000 else 15)


@pytest.mark.parametrize("mark", ["#", "# ", "//", "<!-- ", "/* ", "# // <!-- ", "# = "])
def test_nested_comment_marks_take_time_in_proportion(mark):
    def took(size):
        text = mark * (size // len(mark)) + "\npassword = 'aG7xPq92LmZt'"
        began = time.process_time()
        found = secret_scan.assigned_literals(text)
        assert [text[a:b] for a, b, *_ in found] == (["aG7xPq92LmZt"] if "'" not in mark else [])
        return time.process_time() - began

    assert took(1_000_000) < 2.8 * max(took(500_000), 0.2)


def test_comments_in_comments_keep_their_assignments():
    for line in ("### password = 'aG7xPq92LmZt'", "# old # password = 'aG7xPq92LmZt'", "/* x = 1 // token: aG7xPq92LmZt */", "<!-- # api_key=aG7xPq92LmZt -->", "// see http://a.b # secret = aG7xPq92LmZt"):
        assert [line[a:b] for a, b, *_ in secret_scan.assigned_literals(line)] == ["aG7xPq92LmZt"], line


def test_passphrases_of_several_words():
    find = lambda line: [line[a:b] for a, b, *_ in secret_scan.assigned_literals(line)]
    assert find('passphrase = "correct-horse-42-Battery staple9"') == ["correct-horse-42-Battery staple9"]
    assert find('db_password: "purple kite7 Over 9hills"') == ["purple kite7 Over 9hills"]
    assert find('WALLET_PASSPHRASE = "anchor violin sudden meadow crisp lantern"') == ["anchor violin sudden meadow crisp lantern"]
    for line in ('password_hint = "Please type what you were sent"', 'token_error = "Invalid token after 3 attempts"', 'passphrase = "Enter your passphrase here, please"'):
        assert find(line) == []


def test_forms_that_are_no_types_keep_their_values():
    for line in ("token: aG7xPq92LmZt other = 'x'", "token: aG7xPq92LmZt=", "token: aG7xPq92LmZt"):
        assert [line[a:b].rstrip("=") for a, b, *_ in secret_scan.assigned_literals(line)] == ["aG7xPq92LmZt"]


def test_constants_are_followed_through_any_number_of_names():
    text = 'n0 = "aG7xPq92LmZt"\n' + "".join(f"v{k + 1} = v{k}\n" for k in range(3000)).replace("v0\n", "n0\n", 1) + "password = v3000\n"
    assert [(text[a:b], n) for a, b, _, n in secret_scan.assigned_literals(text)] == [("aG7xPq92LmZt", "password")]


# ---- media


def test_media_round_trip(spark, corpus, empty):
    store = media_chunks.ChunkStore(spark, Scratch(spark, "t").path("store"), 4)
    got = media_chunks.media_columns(corpus, store).toPandas()
    texts = defaultdict(list)
    for r in corpus.collect():
        texts[r["doc_id"]].append((r["text"] or "").encode())
    assert len(got) == corpus.count()
    for r in got[got["doc_id"].notna()].to_dict("records"):
        raw = texts[r["doc_id"]][0]
        full = raw + b"\0" * (-len(raw) % 64 or (64 if not raw else 0))
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(full), hashlib.sha256(full).hexdigest(), zlib.crc32(full[-64:]))
        with io.BytesIO() as f:
            with wave.open(f, "wb") as w:
                w.setnchannels(1)
                w.setsampwidth(1)
                w.setframerate(8000)
                w.writeframes(full)
            assert (r["media_bytes"], r["media_sha256"]) == (len(f.getvalue()), hashlib.sha256(f.getvalue()).hexdigest())
        mean = sum(full) / len(full)
        crossings = sum((a > mean) != (b > mean) for a, b in zip(full, full[1:]))
        rms = (sum((x - mean) ** 2 for x in full) / len(full)) ** 0.5
        told = dict(part.split("=") for part in r["feature"].split(";"))
        assert float(told["mean"]) == pytest.approx(mean, abs=1e-3) and float(told["rms"]) == pytest.approx(rms, abs=1e-3) and int(told["crossings"]) == crossings and told["seconds"] == f"{len(full) / 8000:.3f}"
    held = store.rows().count()
    assert held == store.rows().select("digest").distinct().count()
    store.add(corpus)
    store.compact()
    assert store.rows().count() == held
    assert media_chunks.media_columns(empty, media_chunks.ChunkStore(spark, Scratch(spark, "t").path("store"), 4)).count() == 0


def test_chunks_are_cut_by_content():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 123, 200_000).astype(np.uint8).tobytes()
    a, b = media_chunks.chunks(data), media_chunks.chunks(b"something before " + data)
    assert b"".join(a) == data and all(len(c) <= media_chunks.MOST for c in a) and all(len(c) > media_chunks.LEAST for c in a[:-1])
    assert len(set(a) & set(b)) > 0.7 * len(a)
    slow = [sum(int(media_chunks._GEAR[data[i - k]]) << k for k in range(min(i + 1, 32))) % 2**32 for i in range(200)]
    assert media_chunks.gear(np.frombuffer(data[:200], np.uint8)).tolist() == slow


def test_damaged_medium_is_an_error():
    medium = media_chunks.wave(b"a" * 64)
    assert media_chunks._features(media_chunks.digest(medium), medium)[1] == 64
    for bad in (medium[:-1] + b"b", medium[:-1], b""):
        with pytest.raises(ValueError):
            media_chunks._features(media_chunks.digest(medium), bad)
        with pytest.raises(ValueError):
            media_chunks._features(media_chunks.digest(bad), bad) if bad[-1:] != b"b" else media_chunks.wave_samples(b"x" + bad)


# ---- licences


def test_licenses(spark, corpus, empty):
    texts = ["Licensed under the Apache License, Version 2.0.", "MIT License MIT-License mit  license", "GNU General Public\nLicense general public license", "the license of mit", None, "", "Lizenz é MIT License日", "spdx-license-identifier: BSD-3-Clause", "mit license " * 3000]
    docs = spark.createDataFrame([(1000 + k, t) for k, t in enumerate(texts)], "doc_id BIGINT, text STRING").unionByName(corpus.select("doc_id", "text").filter("doc_id >= 100"))
    source = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in license_scan.scan_licenses(docs).collect():
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(source[r["doc_id"]]))
        places = [(i, label) for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")) for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split()]
        want = len(w), len(places), min((i for i, _ in places), default=None), max((i for i, _ in places), default=None), ",".join(sorted({x for _, x in places}))
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == want
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
    assert license_scan.scan_licenses(empty).count() == 0
    by = {r["doc_id"]: r["labels"] for r in license_scan.scan_licenses(docs).collect()}
    assert by[1000] == "apache,apache-2.0" and by[1007] == "bsd-3-clause" and by[1003] == ""


def test_rules():
    rules = license_rules.rules()
    assert len(rules) > 800 and len({r.name for r in rules}) == len(rules) and sum(len(p) for *_, p in license_rules.PHRASES) > 300
    assert all(min(map(len, rule.keywords)) >= 5 for rule in rules)
    assert license_rules.keywords("(?:a|b) licen[cs]e(?: x+)? y{2,3}z?") == ("a licence", "a license", "b licence", "b license")
    assert license_rules.most_words(r"a (?:b |c d )?(?:\S+ ){1,8}?e") == 12
    inside = license_scan.detect(b"licensed under the apache license version 2 0".split())
    assert [d[2] for d in inside] == ["apache-2.0"]  # contained names are suppressed


def rule_samples(pattern, rng, n):
    """Texts that the pattern matches, with branches, options and counts drawn at random."""
    parser = re._parser

    def draw(tree):
        out = []
        for op, arg in tree:
            if op is parser.LITERAL:
                out.append(chr(arg))
            elif op is parser.IN:
                kind, value = arg[0]
                out.append(chr(value) if kind is parser.LITERAL else {parser.CATEGORY_DIGIT: "4", parser.CATEGORY_NOT_SPACE: "q"}[value])
            elif op is parser.BRANCH:
                out.append(draw(rng.choice(arg[1])))
            elif op is parser.SUBPATTERN:
                out.append(draw(arg[-1]))
            elif op in (parser.MAX_REPEAT, parser.MIN_REPEAT):
                low, high, inner = arg
                out.extend(draw(inner) for _ in range(rng.randint(low, min(high, low + 3))))
            else:
                raise ValueError(op)
        return "".join(out)

    return sorted({draw(parser.parse(pattern)) for _ in range(n)})


def test_every_rule_finds_its_names(spark):
    rng = random.Random(6)
    for rule in license_rules.rules():
        for text in rule_samples(rule.pattern, rng, 40):
            assert any(k in text for k in rule.keywords), (rule.name, text)
            assert len(text.split()) <= license_scan.reach()
    for label, _, names in license_rules.LICENCES:
        pattern = next(re.compile(rule.pattern) for rule in license_rules.rules() if rule.name.startswith(f"name:{label}:"))
        for name in rule_samples(names, rng, 40):
            assert pattern.fullmatch(f"{name} license") and bool(pattern.fullmatch(name)) == ("licen" in name), (label, name)
    wanted = {
        "Boost Software License": "boost-1.0", "Elastic License": "elastic-2.0", "Eclipse Public License 2.0": "epl-2.0", "Eclipse Public License 1.0": "epl-1.0", "Mozilla Public License": "mpl-2.0", "Mozilla Public License 1.1": "mpl-1.1",
        "SIL Open Font License": "ofl-1.1", "The Unlicense": "unlicense", "MIT Licence": "mit", "GPL 1 licence": "gpl-1.0", "Internet Systems Consortium licence": "isc", "Microsoft Public License": "ms-pl", "Apache License 2.0": "apache,apache-2.0",
    }
    docs = spark.createDataFrame(list(enumerate(wanted)), "doc_id BIGINT, text STRING")
    assert {list(wanted)[r["doc_id"]]: r["labels"] for r in license_scan.scan_licenses(docs).collect()} == wanted


def test_every_rule_passes_the_gate(spark):
    rng = random.Random(4)
    cases = [(rule, s) for rule in license_rules.rules() for s in rule_samples(rule.pattern, rng, 12)]
    docs = spark.createDataFrame([(k, s.replace(" ", "\n").title()) for k, (_, s) in enumerate(cases)], "doc_id BIGINT, text STRING")
    for r in license_scan.scan_licenses(docs).collect():
        rule, text = cases[r["doc_id"]]  # what contains a rule's match takes its place
        assert any(d["first_word"] == 0 and d["end_word"] == r["n_words"] for d in r["detections"]), (rule.name, text)
    wanted = {"released under ODbL": "odbl-1.0", "Released under WTFPL": "wtfpl", "Provided under ISC": "isc", "distributed under zlib/libpng": "zlib", "available under EUPL 1.2": "eupl-1.2", "released under\nApache 2.0": "apache-2.0", "released under the\nGPL": "gpl", "public\ndomain": "public-domain"}
    docs = spark.createDataFrame(list(enumerate(wanted)), "doc_id BIGINT, text STRING")
    assert {list(wanted)[r["doc_id"]]: r["labels"] for r in license_scan.scan_licenses(docs).collect()} == wanted


def test_detections_are_those_of_all_rules_on_whole_texts():
    rng = random.Random(11)
    patterns = [(k, rule, re.compile(rf"(?<!\S)(?:{rule.pattern})(?!\S)")) for k, rule in enumerate(license_rules.rules())]
    filler = "the of license under gpl general public mit version 2 0 and copyright zlib software 日本".split()
    for _ in range(60):
        parts = [rule_samples(rng.choice(patterns)[1].pattern, rng, 1)[0] if rng.random() < 0.4 else " ".join(rng.choices(filler, k=rng.randrange(1, 60))) for _ in range(8)]
        words = " ".join(parts).encode().split()
        whole = " ".join(parts)
        found = sorted((-rule.priority, -len(m[0].split()), k, len(whole[: m.start()].split()), rule) for k, rule, p in patterns for m in p.finditer(whole))
        kept = []
        for _, size, _, start, rule in found:
            if not any(a <= start and b >= start - size for a, b, *_ in kept):
                kept.append((start, start - size, rule.label, rule.score, rule.name))
        assert license_scan.detect(words) == sorted(kept)


# ---- token output, packing


def test_token_segments(spark, corpus, empty):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    path = Scratch(spark, "t").path("segments")
    docs = corpus.dropDuplicates(["doc_id"]).filter("doc_id IS NOT NULL")
    token_output.write_token_segments(docs, path, token_output.default_tokenizer(), segment_ids=3000)
    got = {r["doc_id"]: r for r in token_output.read_token_ids(spark, path, token_output.crc32_of_ids, "long").collect()}
    at = 0
    for r in docs.orderBy("doc_id").collect():
        ids = [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 2]
        g = got[r["doc_id"]]
        assert (g["start"], g["n_tokens"], g["value"]) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        for k in {0, len(ids) // 2, len(ids) - 1}:
            if r["doc_id"] % 9 == 0 or len(ids) > 3000:
                assert token_output.token_at(spark, path, r["doc_id"], k) == ids[k]
        at += len(ids)
    assert token_output.catalogue(spark, path).count() > 3
    with pytest.raises(IndexError):
        token_output.token_at(spark, path, 5, 1 << 20)
    with pytest.raises(KeyError):
        token_output.token_at(spark, path, 10_000, 0)
    token_output.write_token_segments(corpus, path + "-all", token_output.default_tokenizer())
    assert token_output.read_token_ids(spark, path + "-all", len, "long").count() == corpus.count()
    token_output.write_token_segments(empty, path + "-none", token_output.default_tokenizer())
    assert token_output.read_token_ids(spark, path + "-none", len, "long").count() == 0


def test_dac_random_access():
    rng = np.random.default_rng(2)
    for ids in (np.zeros(0, np.uint32), np.array([0]), np.array([255, 256, 65535]), rng.integers(0, 49408, 5000), rng.integers(0, 1 << 31, 1500), rng.integers(0, 200, 1024)):
        dac = token_output.Dac(*token_output.dac_encode(np.asarray(ids, np.uint32)))
        assert dac.all().tolist() == list(ids) and [dac[k] for k in range(len(ids))] == list(ids)
        with pytest.raises(IndexError):
            dac[len(ids)]


def test_a_token_takes_a_few_bytes_of_its_file():
    class Counted(io.BytesIO):
        n = 0

        def read(self, size):
            Counted.n += size
            return super().read(size)

    rng = np.random.default_rng(5)
    lengths = rng.integers(1, 3000, 400)
    ids = rng.integers(0, 49408, lengths.sum())
    file = Counted(token_output.segment_bytes(np.arange(400) * 3, lengths, ids))
    segment = token_output.SegmentFile(file)
    for doc in rng.integers(0, 400, 50).tolist():
        Counted.n, first = 0, int(lengths[:doc].sum())
        at, end = segment.place(doc * 3)
        assert (at, end) == (first, first + lengths[doc]) and segment.token(end - 1) == ids[end - 1]
        assert Counted.n < 400  # of more than a million
    assert segment.place(1) is None and segment.whole()[2].tolist() == ids.tolist()


def test_packing(spark, corpus, empty):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    got = packing.pack(spark, corpus, packing.default_tokenizer()).toPandas()
    ids = {}
    for r in corpus.collect():
        if r["doc_id"] is not None:
            ids[r["doc_id"]] = [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 2]
    seen = defaultdict(list)
    for r in got[got["doc_id"].notna()].to_dict("records"):
        own = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert len(own) == r["length"] and zlib.crc32(np.array(own, "<u4").tobytes()) == r["ids_crc32"] and np.frombuffer(r["ids"], "<u2").tolist() == own
        seen[r["doc_id"]].append((r["piece"], r["start"], r["length"]))
    assert set(seen) == set(ids)
    for doc, pieces in seen.items():
        pieces = sorted(set(pieces))
        assert [p for p, _, _ in pieces] == list(range(len(pieces))) and sum(n for _, _, n in pieces) == len(ids[doc]) and all(n == 1024 for _, _, n in pieces[1:])
        assert len(pieces) == -(-len(ids[doc]) // 1024)
    for _, s in got.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert s["offset"].tolist() == [0, *np.cumsum(s["length"])[:-1]] and s["length"].sum() <= 1024
    assert got["sequence_id"].nunique() <= -(-got["length"].sum() // 1024) + 2
    assert packing.pack(spark, empty, packing.default_tokenizer()).count() == 0
    whole = packing.sequences(packing.pack(spark, corpus, packing.default_tokenizer())).toPandas()
    assert (whole["ids"].map(len) == 2 * whole["n_tokens"]).all() and whole["n_tokens"].sum() == got["length"].sum()


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    counts = np.zeros(1025, np.int64)
    for x in rng.integers(1, [1025, 40, 600, 520, 1025, 342][seed], [3000, 500, 7, 40000, 1, 2000][seed]):
        counts[x] += rng.integers(1, 50) if seed == 3 else 1
    used = np.zeros(1025, np.int64)
    n = 0
    for lengths, times in packing.plan(counts):
        assert times > 0 and sum(lengths) <= 1024
        n += times
        for x in lengths:
            used[x] += times
    assert (used == counts).all()
    assert n <= -(-int(counts @ np.arange(1025)) // 1024) * 1.03 + 1 or seed in (2, 3)


def test_sum_index_finds_combinations_as_brute_force_does():
    rng = np.random.default_rng(3)
    for upward in (True, False):
        counts = np.zeros(61, np.int64)
        counts[rng.integers(1, 61, 25)] = rng.integers(1, 4, 25)
        index = packing.SumIndex(counts, upward)
        for total in rng.integers(1, 61, 400).tolist():
            lengths = [x for x in range(1, 61) for _ in range(int(index.left[x]))]
            for k, find in ((1, index.single), (2, index.pair), (3, index.triple)):
                found = find(total)
                possible = any(sum(c) == total for c in itertools.combinations(lengths, k))
                assert (found is not None) == possible and (found is None or (sum(found) == total and len(found) == k and index.times(found) > 0))
                most = int(rng.integers(1, total + 1))
                low = find(total, most)
                assert (low is not None) == any(sum(c) == total and max(c) <= most for c in itertools.combinations(lengths, k))
                if found and rng.random() < 0.1:
                    index.take(found, 1)
                    lengths = [x for x in range(1, 61) for _ in range(int(index.left[x]))]


def test_plan_of_lengths_about_a_third():
    counts = np.bincount(np.random.default_rng(0).integers(330, 360, 9000), minlength=1025)
    assert sum(times for _, times in packing.plan(counts)) <= 3346
    counts = np.bincount(np.random.default_rng(0).integers(1, 1025, 20000), minlength=1025)
    assert sum(times for _, times in packing.plan(counts)) <= 10025


def test_combinations_leave_gaps_to_longer_pieces():
    """Beside 520, 504 fits alone or 300 with 204: the longer one has it, and all four pieces take two sequences."""
    counts = np.bincount([520, 724, 500, 300, 4], minlength=1025)
    made = packing.plan(counts)
    assert sorted(tuple(sorted(lengths)) for lengths, _ in made) == [(4, 500, 520), (300, 724)]
    counts = np.bincount([600, 200, 124, 100, 700, 108, 108, 108], minlength=1025)
    assert [sum(lengths) for lengths, _ in packing.plan(counts)] == [1024, 1024]  # beside 600 and 700, by three and by two


def test_sequences_on_the_tables(spark):
    assert packing.op8_best_fit_packing(spark, "/root/testdata/sf0.01").select("sequence_id").distinct().count() <= 964


# ---- near dedup


def brute_components(rows):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                p, q = sorted((find(i), find(j)))
                root[q] = p
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_near_components(spark, corpus, empty):
    got = near_dedup.near_components(corpus).collect()
    want = brute_components([(r["doc_id"], r["text"]) for r in corpus.collect() if r["doc_id"] is not None])
    assert len(got) == corpus.count()
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and not r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]] and r["kept"] == (r["doc_id"] == r["component_id"])
    assert near_dedup.near_components(empty).count() == 0
    assert near_dedup.drop_near_copies(corpus).columns == corpus.columns


def test_near_components_of_a_large_group(spark):
    rng = np.random.default_rng(8)
    words = [f"w{k}" for k in range(500)]
    base = list(rng.choice(words, 150))
    rows = []
    for k in range(260):  # many copies with few or more words changed: chains, and pairs on either side of the limit
        w = list(base)
        for at in rng.integers(0, 150, int(rng.integers(0, 7))):
            w[at] = f"new{rng.integers(1000)}"
        rows.append((k, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    want = brute_components(rows)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.near_components(docs).collect()} == want


def test_pigeonhole_finds_every_pair_within_the_distance():
    rng = np.random.default_rng(4)
    for _ in range(60):
        a = rng.integers(0, 1 << 16, (1, near_dedup.SYMBOLS), dtype=np.uint16)
        b = a.copy()
        for at in rng.choice(near_dedup.SYMBOLS, near_dedup.DISTANCE, replace=False):
            b[0, at] ^= 1 + int(rng.integers(1000))
        assert (near_dedup.chunk_keys(a) == near_dedup.chunk_keys(b)).any()


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(6)
    shares = []
    for _ in range(60):
        x = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
        shares.append(np.equal(*near_dedup.signatures([np.sort(x[:270]), np.sort(x[30:])])).mean())
    assert abs(np.mean(shares) - 0.8) < 0.03
    x = rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
    a, b = np.sort(x[:900]), np.sort(x[100:])
    assert near_dedup._common_many([a, b, b[:5]], np.zeros(300, int), np.tile([1, 2, 1], 100)).tolist() == [800, 5, 800] * 100


def test_connected_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "u BIGINT, v BIGINT"), Scratch(spark, "t"), "c").collect()}
    assert got == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 140)}, 200: 200, 201: 200}
    assert components.components(spark.createDataFrame([], "u BIGINT, v BIGINT"), Scratch(spark, "t"), "c").count() == 0


# ---- mixing


def test_rates_meet_the_targets(spark):
    rng = np.random.default_rng(9)
    p = rng.dirichlet([0.3, 0.3, 0.3], 400)
    tokens = rng.integers(1, 500, 400)
    members = spark.createDataFrame([(int(t), q.tolist()) for t, q in zip(tokens, p)], "n_tokens BIGINT, posterior ARRAY<DOUBLE>").repartition(3)
    weights = np.array([0.2, 0.3, 0.5])
    for total, most in ((None, float("inf")), (float(tokens.sum()) * 0.5, 1.0), (None, 1.0)):
        fitted = mixing.fit(mixing.over(members, 3, most), weights, total, most)
        r = mixing.rates(p, fitted.steps, most)
        have = (r * tokens) @ p
        assert (r >= 0).all() and (r <= most).all() and have == pytest.approx(fitted.have)
        assert fitted.met and np.abs(have / have.sum() - weights).max() < 1e-5


def measured_here(p, tokens, most):
    """What over() gives, without Spark."""
    return lambda steps, tried, along: mixing._read(mixing.measured(p, tokens, steps, tried, along, most), p.shape[1], most)


@pytest.mark.parametrize("most", [np.inf, 1.0, 2.0])
def test_all_reachable_targets_are_met(most):
    """1,000 targets for each bound that some rates are known to reach, of which none is below a ten-thousandth of all."""
    rng = np.random.default_rng(12)
    done = 0
    while done < 1000:
        n, rows = int(rng.integers(2, 7)), int(rng.integers(50, 400))
        p, tokens = rng.dirichlet(np.full(n, rng.choice([0.1, 0.3, 1, 3])), rows), rng.integers(1, 1000, rows).astype(float)
        r = np.where(rng.random(rows) < rng.choice([0.0, 0.5, 0.9]), 0, rng.uniform(0, min(most, 3.0), rows))
        want = (tokens * r) @ p
        if want.min() < 1e-4 * want.sum():
            continue
        fitted = mixing.fit(measured_here(p, tokens, most), want / want.sum(), want.sum(), most)
        assert fitted.met and (fitted.off <= 1e-5).all(), (n, rows, fitted.off)
        done += 1


def test_without_repeats_the_total_is_the_largest_that_can_be_met():
    """Of two domains, all bounds y . want <= reach are tried: the least total that one leaves is the largest that can be met."""
    rng = np.random.default_rng(13)
    angles = np.linspace(-np.pi, np.pi, 4001)
    for _ in range(40):
        p, tokens = rng.dirichlet([0.4, 0.4], 300), rng.integers(1, 500, 300).astype(float)
        weights = rng.dirichlet([3.0, 3.0])
        fitted = mixing.fit(measured_here(p, tokens, 1.0), weights, None, 1.0)
        y = np.stack([np.cos(angles), np.sin(angles)])
        reach, along = np.maximum(p @ y, 0).T @ tokens, weights @ y
        largest = (reach[along > 1e-6] / along[along > 1e-6]).min()
        assert fitted.met and largest * 0.98 < fitted.want.sum() < largest * 1.001


def test_a_domain_that_nothing_is_in_is_out_of_reach():
    p = np.array([[1.0, 0.0], [1.0, 0.0]])
    for most in (1.0, np.inf):
        fitted = mixing.fit(measured_here(p, np.array([3.0, 4.0]), most), np.array([0.5, 0.5]), None, most)
        assert not fitted.met and fitted.have[0] == pytest.approx(3.5)  # half of all tokens


@pytest.mark.parametrize(("weights", "share", "most"), [([0.2, 0.3, 0.5], 1.0, np.inf), ([0.98, 0.01, 0.01], 0.3, 1.0), ([0.5, 0.5, 0.0], 0.6, 1.0)])
def test_rates_solve_the_least_squares(spark, weights, share, most):
    """Against coordinate descent on the same bounded least squares; the last two are out of reach."""
    rng = np.random.default_rng(10)
    p, tokens, weights = rng.dirichlet([0.5] * 3, 80), rng.integers(1, 60, 80), np.array(weights)
    members = spark.createDataFrame([(int(t), q.tolist()) for t, q in zip(tokens, p)], "n_tokens BIGINT, posterior ARRAY<DOUBLE>")
    fitted = mixing.fit(mixing.over(members, 3, most), weights, share * tokens.sum(), most)
    assert fitted.met == (most > 1)
    metric = np.linalg.pinv((p * tokens[:, None]).T @ p)
    a, want, r = p * tokens[:, None], weights * share * tokens.sum(), np.ones(80)
    for _ in range(300):
        for i in range(80):
            r[i] = min(max(r[i] - a[i] @ metric @ (a.T @ r - want) / (a[i] @ metric @ a[i]), 0.0), most)
    loss = lambda x: (x - want) @ metric @ (x - want)
    assert loss(fitted.have) == pytest.approx(loss(a.T @ r), rel=0.01, abs=1e-6)
    assert fitted.have == pytest.approx(a.T @ r, abs=0.01 * tokens.sum())


def test_mixing(spark, corpus, empty):
    labelled = corpus.select("doc_id", F.col("lang").alias("domain"))
    got = mixing.mixed_rates(corpus, labelled, {"en": 1, "de": 1})
    rows = got.collect()
    assert len(rows) == corpus.count() and all(abs(sum(r["posterior"]) - 1) < 1e-9 and r["rate"] >= 0 and r["copies"] in (int(r["rate"]), int(r["rate"]) + 1) for r in rows)
    assert [r["n_tokens"] for r in rows if r["doc_id"] == 0] == [len(r["text"].split()) for r in corpus.filter("doc_id = 0").collect()]
    assert mixing.mixed_rates(empty, labelled, {"en": 1, "de": 1}).count() == 0
    flat = mixing.mixed_rates(corpus, labelled.filter("false"), {"en": 1, "de": 1}).collect()
    assert all(r["posterior"] == [0.5, 0.5] for r in flat)
    assert mixing.mix(corpus, labelled, {"en": 1, "de": 1}).columns == corpus.columns
    shared = corpus.filter("doc_id IS NOT NULL").union(corpus.filter("doc_id = 4").withColumn("text", F.lit("other words")))
    assert mixing.mix(shared, labelled, {"en": 1, "de": 1}, most=3.0).groupBy("doc_id").count().filter("doc_id = 4 AND count % 4 <> 0").isEmpty()  # four rows, as often each
    with pytest.raises(ValueError):
        mixing.mixed_rates(corpus, labelled, {"en": 0})


# ---- kernels


def test_hashes_depend_on_the_bytes_alone():
    texts = [b"abc def", b"", b"def abc abc", b"\xc3\xa9"]
    data, first, last = kernels.joined(texts)
    starts, ends = kernels.runs(~kernels.SPACE[data])
    h = kernels.Hashes(data).of(starts, ends).tolist()
    assert h[0] == h[3] == h[4] and h[1] == h[2] and len(set(h)) == 3
    assert [bytes(data[a:b]) for a, b in zip(first, last)] == texts
    assert kernels.segment_sums(np.array([1.0, 2, 3]), np.array([0, 1, 3]), np.array([2, 1, 3])).tolist() == [3, 0, 0]
    assert [(k, len(b)) for k, b in kernels.blocks(["x" * 10] * 7 + [None], 25)] == [(0, 3), (3, 3), (6, 2)]
