"""Exact dedup, mixing, quality rules and secret ledger beyond their SQL parity."""

import hashlib
import math
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tests.llm.conftest import write_sf
from tierlake.llm import exact_dedup, mixing, rule_ledger, secret_ledger
from tierlake.llm.queries import QUERIES


def strip(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def test_exact_dedup_keeps_one_row_of_each_group(edge_docs):
    rows = edge_docs.collect()
    groups = defaultdict(list)
    for r in rows:
        groups[strip(r.text)].append(r)
    want = Counter()
    for g in groups.values():
        best = min(g, key=lambda r: (-len(r.text or ""), r.doc_id is None, r.doc_id or 0))
        want[best.doc_id] += 1
    for support in (1 / 512, 0.2, 0.9):          # nothing, the copies, and everything beyond the heavy share
        out = exact_dedup.drop_exact_duplicates(edge_docs, support)
        assert out.columns == edge_docs.columns
        assert Counter(r.doc_id for r in out.collect()) == want
        report = exact_dedup.duplicate_report(edge_docs, support).collect()
        assert len(report) == len(rows) and sum(r.kept for r in report) == len(groups)
        assert Counter(r.group_size for r in report) == Counter(len(groups[strip(r.text)]) for r in rows)


def test_misra_gries_finds_every_heavy_digest_within_its_bound(spark):
    keyed = spark.range(0, 9000, numPartitions=7).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 10 == 1, "warm").otherwise(
            F.col("id").cast("string")).alias("__digest"))
    found = [r[0] for r in exact_dedup.frequent_digests(keyed, 0.05).collect()]
    assert {"hot", "warm"} <= set(found) and len(found) <= 20


def test_empty_table_keeps_columns(empty_docs):
    assert exact_dedup.drop_exact_duplicates(empty_docs).collect() == []
    assert mixing.mixed_documents(empty_docs).columns == empty_docs.columns


def targets_by_resharing(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """The contract's own words: cap, reshare the excess by weight, repeat."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, target, free = share * sum(sizes.values()), {}, set(names)
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] >= most * sizes[s]}
        if not over:
            return target | {s: level * weight[s] for s in free}
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
        free -= over
    return target


def test_mixing_meets_targets_and_is_reproducible(edge_docs, small_docs):
    for docs in (edge_docs, small_docs):
        out = mixing.mix(docs).collect()
        sizes, taken, target = Counter(), Counter(), {}
        for r in out:
            sizes[r.source] += r.size
            taken[r.source] += r.taken
            target[r.source] = r.target
            assert 0 <= r.taken <= 2 * r.size
        assert {s: round(t, 6) for s, t in targets_by_resharing(sizes).items()} == {s: round(t, 6) for s, t in target.items()}
        for s in sizes:
            assert abs(taken[s] - target[s]) <= 0.5, s
        again = mixing.mix(docs.repartition(3)).collect()
        assert Counter(out) == Counter(again)


def test_tiny_sources_meet_their_targets_beside_hot_ones(spark, tmp_path):
    small = (3, 300, 1_500, 4_000)
    rows = [(100 * k + i, " ".join(["w"] * 2_000), "big%02d" % k) for k in range(20) for i in range(100)]
    rows += [(10_000 + 10 * k + i, " ".join(["w"] * (n // 3)), "tiny%d" % k) for k, n in enumerate(small) for i in range(3)]
    rows += [(20_000, "", "none")]
    source = {d: s for d, _, s in rows}
    sf = write_sf(tmp_path, [(d, t, "en", s, len(t)) for d, t, s in rows])
    taken, target = Counter(), {}
    for r in QUERIES["op9_mixing"](spark, sf).collect():
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
    assert all(target["tiny%d" % k] > 0 for k in range(len(small))) and target["none"] == 0
    for s in target:
        assert abs(taken[s] - target[s]) <= 0.5, s


def test_op9_apportions_blocks_and_settles_them_to_the_word(spark, tmp_path):
    sizes = {"a": 9_000, "b": 7_000, "c": 4_000, "tiny": 1}
    rows = [(100 * k + i, " ".join(["w"] * min(90, n - 90 * i)), "en", s, n)
            for k, (s, n) in enumerate(sizes.items()) for i in range(-(-n // 90))]
    source = {r[0]: r[3] for r in rows}
    taken, target, blocks, settled = Counter(), {}, {}, {}
    for r in QUERIES["op9_mixing"](spark, write_sf(tmp_path, rows)).collect():
        s = source[r.doc_id]
        assert 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
        target[s], blocks[s], settled[s] = r.target, r.blocks, r.settled
    block = -(-int(sum(target.values())) // mixing.TOTAL_BLOCKS)
    quotients = sorted((-t / (2 * k + 1), s) for s, t in target.items() for k in range(int(t)))
    won = Counter(s for _, s in quotients[:round(sum(target.values()) / block)])
    assert blocks == {s: won[s] for s in sizes} and blocks["tiny"] == 0
    for s, n in sizes.items():
        assert abs(taken[s] - target[s]) <= 0.5
        assert abs(settled[s]) <= 2 * block


def test_sainte_lague_quotas_follow_highest_quotients(spark):
    t = spark.createDataFrame([("a", 1, 530, 530.0), ("b", 2, 310, 310.0), ("c", 3, 160, 160.0)],
                              "source string, source_no long, source_size long, target double")
    rows = mixing.apportion(t, total_blocks=10, shards=2).collect()
    # 1000 words in 10 blocks: the classic seats 5, 3, 2
    assert Counter(r.source_no for r in rows) == {1: 5, 2: 3, 3: 2}
    assert Counter(r.shard for r in rows) == {0: 5, 1: 5}


def test_mixed_documents_repeat_whole_rows(edge_docs):
    out = mixing.mixed_documents(edge_docs)
    assert out.columns == edge_docs.columns
    have = Counter(r.text for r in edge_docs.collect())
    assert all(n <= 2 * have[t] for t, n in Counter(r.text for r in out.collect()).items())


def test_written_words_are_within_a_document_of_the_targets(spark, small_docs):
    # long documents of several blocks each, one id shared by many of them, and short ones beside
    rows = [(None if k == 0 else 100 * k + i, "%d " % i + " ".join(["w"] * (3_000 + 7 * i)), "long%d" % k)
            for k in range(4) for i in range(40)]
    rows += [(None if i < 30 else 1_000 + i, "%d a b c" % i, "short") for i in range(60)]
    for docs in (spark.createDataFrame(rows, "doc_id long, text string, source string"), small_docs):
        target, longest, written = {}, Counter(), Counter()
        for r in mixing.mix(docs).collect():
            target[r.source] = r.target
            longest[r.source] = max(longest[r.source], r.size)
        for r in mixing.mixed_documents(docs).collect():
            written[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
        for s in target:
            assert abs(written[s] - target[s]) <= longest[s] / 2 + 0.5, s


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def dealt_by_blocks(rows, total_blocks):
    """Copies of each text of (doc_id, text, source): whole blocks by highest quotients, in seeded order, then
    to the word; a block holds the documents that begin in it."""
    streams = defaultdict(list)
    for d, t, s in rows:
        parts = [mixing.SEED] + ([] if d is None else [str(d)]) + [md5(t)]
        streams[s].append((md5(":".join(parts)), len(t.split()), t))
    size = {s: sum(n for _, n, _ in docs) for s, docs in streams.items()}
    target = targets_by_resharing(size)
    block = math.ceil(sum(target.values()) / total_blocks)
    quotients = sorted((-t / (2 * k + 1), s) for s, t in target.items() for k in range(int(t)))
    seats = Counter(s for _, s in quotients[:round(sum(target.values()) / block)])
    copies = Counter()
    for no, s in enumerate(sorted(streams), 1):
        blocks, at = defaultdict(list), 0
        for _, n, t in sorted(streams[s]):
            blocks[at // block].append((n, t))
            at += n
        order = sorted(range(-(-size[s] // block)), key=lambda b: (md5(f"{mixing.SEED}:{no}:{b}"), b))
        length = {b: sum(n for n, _ in blocks[b]) for b in order}
        taken, part = Counter(), Counter()
        for k in range(seats[s]):                                                           # the quota
            taken[order[k % len(order)]] += 1
        at, missing = seats[s], round(target[s]) - sum(taken[b] * length[b] for b in order)
        while missing < 0:                                                                  # given back by the last ones
            at -= 1
            b = order[at % len(order)]
            taken[b], missing = taken[b] - 1, missing + length[b]
        while missing > 0:                                                                  # taken from the next ones
            b = order[at % len(order)]
            if missing >= length[b]:
                taken[b] += 1
            else:
                part[b] = missing
            at, missing = at + 1, missing - length[b]
        for b in order:
            for n, t in blocks[b]:
                copies[t] += taken[b] + (part[b] >= n / 2)
                part[b] = max(0, part[b] - n)
    return copies, target, seats, block


def test_mixed_documents_are_dealt_by_blocks(spark):
    rows = [(None if i % 7 == 0 else 1_000 * k + i, "%d " % (1_000 * k + i) + " ".join(["w"] * (9 + (i * 5) % 23)), s)
            for k, (s, n) in enumerate({"a": 300, "b": 230, "c": 90, "d": 3}.items()) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    want, target, seats, block = dealt_by_blocks(rows, 64)
    assert +want == Counter(r.text for r in mixing.mixed_documents(docs, total_blocks=64).collect())
    plan = mixing.mix(docs, total_blocks=64).collect()
    assert {r.source: r.blocks for r in plan} == {s: seats[s] for s in target}
    assert all(abs(r.settled) <= 3 * block for r in plan)
    hashed = mixing.mixed_documents(docs, total_blocks=1_000_000)      # a document a block: other documents are taken
    assert Counter(r.text for r in hashed.collect()) != +want


def test_equal_rows_are_mixed_alike(spark):
    rows = [(7, "same words here", "b")] * 60 + [(100 + i, "%d b c d e" % i, "b") for i in range(60)]
    rows += [(1_000 + i, "%d x y z" % i, "a") for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    taken = [r.taken for r in mixing.mix(docs, total_blocks=64).collect() if r.doc_id == 7]
    whole = Counter(t // 3 for t in taken)
    assert len(taken) == 60 and sum(t % 3 > 0 for t in taken) <= 1 and len(whole) <= 2
    held = Counter(r.text for r in mixing.mixed_documents(docs, total_blocks=64).collect())["same words here"]
    assert held == 60 * int(sum(taken) / 180 + 0.5)


def test_rule_bits_policies_and_ablation(edge_docs):
    ledger = rule_ledger.measure(edge_docs).cache()
    rows = ledger.collect()
    for r in rows:
        values = r.asDict()
        bits = sum(1 << k for k, rule in enumerate(rule_ledger.RULES.values()) if eval(rule, {}, values))
        assert bits == r.fail_bits
    no_symbols = rule_ledger.Policy("v2", ("few_words", "upper_case"))
    kept = {r.doc_id: r.kept for r in rule_ledger.apply_policy(ledger, no_symbols).collect()}
    base = rule_ledger.BASE.mask | no_symbols.mask
    assert all(kept[r.doc_id] == (r.fail_bits & base == 0) for r in rows)
    for a in rule_ledger.ablation(ledger, (rule_ledger.STRICT, no_symbols)).collect():
        p = {"v1": rule_ledger.STRICT, "v2": no_symbols}[a.policy]
        bit = rule_ledger.Policy("", (a.rule,)).mask
        assert a.failing == sum(r.fail_bits & bit != 0 for r in rows)
        assert a.only_this == sum(r.fail_bits & p.mask == bit for r in rows)
        assert a.kept_without == sum(r.fail_bits & p.mask & ~bit == 0 for r in rows)


def test_a_second_policy_reads_no_text(spark, tmp, edge_docs, monkeypatch):
    path = rule_ledger.store(edge_docs, tmp)
    ledger = rule_ledger.read_ledger(spark, path)
    assert sorted(map(repr, ledger.collect())) == sorted(map(repr, rule_ledger.measure(edge_docs).collect()))
    other = rule_ledger.Policy("v2", ("few_words", "upper_case"))
    for df in (rule_ledger.apply_policy(ledger), rule_ledger.apply_policy(ledger, other),
               rule_ledger.ablation(ledger, (rule_ledger.STRICT, other))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        scans = re.findall(r"FileScan parquet \[([^]]*)\]", plan)
        assert len(scans) == 1 and "fail_bits" in scans[0] and "text" not in scans[0]
    # another catalogue's ledger lies beside it
    monkeypatch.setattr(rule_ledger, "CATALOGUE", "other")
    rule_ledger.store(edge_docs.limit(3), path)
    assert rule_ledger.read_ledger(spark, path, "other").count() == 3 and ledger.count() == edge_docs.count()


def test_pairs_appended_twice_count_once(spark, tmp, edge_docs):
    versions = edge_docs.select("doc_id", "text")
    new = secret_ledger.scan_unseen(versions)
    for _ in range(2):
        new.write.mode("append").parquet(tmp)
    twice = secret_ledger.findings_by_version(versions, secret_ledger.read_ledger(spark, tmp))
    once = secret_ledger.scan(versions)
    assert sorted(map(repr, twice.select("doc_id", "findings").collect())) == sorted(
        map(repr, once.select("doc_id", "findings").collect()))


def test_ledger_scans_only_unseen_pairs(spark, edge_docs):
    versions = edge_docs.select("doc_id", "text")
    first = versions.filter("doc_id < 50")
    path = secret_ledger.update_ledger(first)
    n = spark.read.parquet(path).count()
    assert n == 3 * first.select(F.coalesce("text", F.lit(""))).distinct().count()
    secret_ledger.update_ledger(first, path)
    assert spark.read.parquet(path).count() == n                      # nothing new
    secret_ledger.update_ledger(versions, path)
    blobs = versions.select(F.coalesce("text", F.lit(""))).distinct().count()
    assert spark.read.parquet(path).count() == 3 * blobs              # only the new blobs
    newer = (*secret_ledger.RULES[:2], secret_ledger.Rule("hex", 2, r"[0-9a-f]{17,}"))
    secret_ledger.update_ledger(versions, path, newer)
    assert spark.read.parquet(path).count() == 4 * blobs              # only the new rule version
    found = secret_ledger.findings_by_version(versions, spark.read.parquet(path), newer)
    got = {r.doc_id: [(s.kind, s.end - s.start) for s in r.findings] for r in found.collect()}
    assert got[11] == [("hex", 17), ("assign", 28), ("access", 21)] or ("hex", 17) in got[11]
    assert all(k != "hex" or n >= 17 for f in got.values() for k, n in f)


def python_spans(text):
    """Leftmost non-overlapping matches, filtered afterwards, as the contract says."""
    rules = [("assign", r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12),
             ("access", r"AKIA[A-Z0-9]+", 0, 18), ("hex", r"[0-9a-f]+", 0, 16)]
    out = []
    for no, (kind, pattern, group, least) in enumerate(rules):
        if kind == "assign":
            pattern = pattern.replace("(?i:", "(?ai:")                 # ASCII case only
        out += [(m.start(), no, kind, m.end()) for m in re.finditer(pattern, text) if len(m[group]) >= least]
    return ",".join(f"{k}:{a}:{z}" for a, _, k, z in sorted(out))


def test_secret_spans_equal_python(edge_docs, small_docs):
    for docs in (edge_docs, small_docs):
        rows = secret_ledger.scan(docs.select("doc_id", "text")).select(
            "doc_id", secret_ledger.written(F.col("findings")).alias("s")).collect()
        texts = Counter((r.doc_id, python_spans(r.text or "")) for r in docs.select("doc_id", "text").collect())
        assert Counter((r.doc_id, r.s) for r in rows) == texts
