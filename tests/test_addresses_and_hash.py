import hashlib
import ipaddress
import random

import pytest
from pyspark.sql import functions as F

from hitledger.functions.addresses import address_key
from hitledger.functions.iphash import hll_hash, register_hexes
from hitledger.operators.registers import estimate_clients, estimated, merged, registers

VECTORS = [
    ("14.176.79.196", "830e01", "fd0b07"),
    ("212.181.25.47", "890004", "630202"),
    ("2001:db8::8a2e:370:7334", "030a01", "0e0605"),
    ("0.0.0.0", "500704", "fb0201"),
    ("::1", "c50c06", "140a03"),
]


def packed(text):
    try:
        address = ipaddress.ip_address(text)
    except ValueError:
        return None
    return bytes([address.version]) + address.packed


def test_address_key_agrees_with_the_standard_library(spark):
    rng = random.Random(5)
    texts = [str(ipaddress.IPv4Address(rng.getrandbits(32))) for _ in range(200)]
    texts += [str(ipaddress.IPv6Address(rng.getrandbits(128))) for _ in range(100)]
    sparse = [rng.getrandbits(128) & rng.choice([0xFFFF << 64, (1 << 32) - 1, 0xFFFF << 112]) for _ in range(100)]
    texts += [str(ipaddress.IPv6Address(v)) for v in sparse]
    texts += [
        "::", "::1", "1::", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8", "::ffff:1.2.3.4", "1:2:3:4:5:6:1.2.3.4",
        "ABCD::EF01", "2001:DB8::8a2e:370:7334",
        # malformed
        "999.1.1.1", "1.2.3", "1.2.3.4.5", "01.2.3.4", "1..2.3", ":::", "1:2:3:4:5:6:7:8::", "1::2::3",
        "1:2:3:4:5:6:7", "1:2:3:4:5:6:7:8:9", "12345::", ":1:2:3:4:5:6:7", "::1.2.3", "::1.2.3.444", ".", ":", "abc",
        "1:2:3:4:5:6:7:1.2.3.4", "1.2.3.4::", "::1.2.3.4:5",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "ip string")
    got = {r.ip: r.k for r in df.select("ip", address_key(F.col("ip")).alias("k")).collect()}
    wrong = {
        t: (k and bytes(k), packed(t)) for t, k in got.items() if (k and bytes(k)) != packed(t)
    }
    assert not wrong


@pytest.mark.parametrize("secret,position", [(b"", 1), (b"k", 2)])
def test_golden_hashes(spark, secret, position):
    df = spark.createDataFrame([(v[0],) for v in VECTORS] + [("999.1.1.1",), (None,)], "ip string")
    got = {r.ip: r.h for r in df.select("ip", hll_hash(F.col("ip"), secret).alias("h")).collect()}
    assert got == {v[0]: v[position] for v in VECTORS} | {"999.1.1.1": None, None: None}


def test_hash_shape_and_independence_of_partitioning(spark):
    df = spark.range(3000).select(
        F.concat(F.lit("10."), F.col("id") % 7, F.lit("."), F.col("id") % 251, F.lit(".9")).alias("ip")
    )
    one = df.coalesce(1).select("ip", hll_hash(F.col("ip")).alias("h")).distinct().collect()
    many = df.repartition(9).select("ip", hll_hash(F.col("ip")).alias("h")).distinct().collect()
    assert sorted(one) == sorted(many)
    for row in one:
        low, high, rank = bytes.fromhex(row.h)
        assert high <= 0x0F and 1 <= rank <= 19


def by_the_letter(secret, address):
    """The published rule, one byte at a time."""
    data, half = bytearray(address), len(address) // 2
    for turn in range(16):
        digest = hashlib.sha512(bytes([turn]) + secret + bytes(data[half:])).digest()
        for i, x in enumerate(digest):
            data[i % half] ^= x
        if turn < 15:
            data[:half], data[half:] = data[half:], data[:half]
    value = int.from_bytes(data[:4], "big")
    bucket, bits = value & 0xFFF, f"{value & 0xFFFFC000:032b}"
    rank = len(bits) - len(bits.lstrip("1"))
    return bytes([bucket & 255, bucket >> 8, rank + 1]).hex()


def test_batch_hash_agrees_with_the_rule_by_the_letter():
    rng = random.Random(3)
    for secret in (b"", b"some key"):
        batch = [rng.randbytes(rng.choice([4, 16])) for _ in range(3000)]
        got = register_hexes(secret, batch)
        assert all(got[a] == by_the_letter(secret, a) for a in batch)
    assert max(int(h[4:], 16) for h in got.values()) > 8


def test_estimate_and_merge(spark):
    ips = spark.range(20000).select(
        (F.col("id") % 2).alias("half"),
        F.concat_ws(".", F.lit("10"), (F.col("id") / 65536).cast("int"), (F.col("id") / 256).cast("int") % 256, F.col("id") % 256).alias("ip"),
    )
    hashed = ips.withColumn("hll_hash", hll_hash(F.col("ip"), b"k"))
    whole = estimate_clients(hashed, []).collect()[0].clients
    assert abs(whole - 20000) / 20000 < 0.05
    parts = registers(hashed, ["half"])
    assert estimated(merged(parts, []), []).collect()[0].clients == whole
    small = estimate_clients(hashed.where("half = 0").limit(500), []).collect()[0].clients
    assert abs(small - 500) / 500 < 0.1
