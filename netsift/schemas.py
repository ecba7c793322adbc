"""Record layouts and fixed values.

Everything in the FIXED VALUES block must stay exactly as written: these are
the names, lists and patterns the records and policies are defined by.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES (record format definitions; do not edit)
# ---------------------------------------------------------------------------

# Default flow header: the 48 raw cell names in line order.
DEFAULT_FLOW_HEADER = (
    "ts,te,td,sa,da,sp,dp,pr,flg,fwd,stos,ipkt,ibyt,opkt,obyt,in,out,sas,das,smk,dmk,dtos,dir,nh,nhb,"
    "svln,dvln,ismc,odmc,idmc,osmc,mpls1,mpls2,mpls3,mpls4,mpls5,mpls6,mpls7,mpls8,mpls9,mpls10,"
    "cl,sl,al,ra,eng,exid,tr"
)

# Derived flow cells, appended to the right of the raw cells in this order.
DERIVED_COLUMNS = (
    "tpkt", "tbyt", "cp",
    "prtcp", "prudp", "pricmp", "prigmp", "prother",
    "flga", "flgs", "flgf", "flgr", "flgp", "flgu",
)

# Destination ports of common services: FTP 20 21, SSH 22, Telnet 23, SMTP 25,
# DNS 53, DHCP 67 68, TFTP 69, HTTP 80, POP3 110, NNTP 119, NTP 123, IMAP4 143,
# SNMP 161, LDAP 389, HTTPS 443, IMAPS 993, RADIUS 1812, AIM 5190.
COMMON_PORTS = (20, 21, 22, 23, 25, 53, 67, 68, 69, 80, 110, 119, 123, 143, 161, 389, 443, 993, 1812, 5190)

# Protocols with their own one-hot cell; anything else sets `prother`.
NAMED_PROTOCOLS = (("prtcp", "TCP"), ("prudp", "UDP"), ("pricmp", "ICMP"), ("prigmp", "IGMP"))

# TCP-flag cells: set when the upper-cased flag text contains the letter or `X`.
FLAG_LETTERS = (("flga", "A"), ("flgs", "S"), ("flgf", "F"), ("flgr", "R"), ("flgp", "P"), ("flgu", "U"))

# Columns anonymized when the caller names none.
DEFAULT_ANONYMIZE_COLUMNS = ("sa", "da")

# Log line layout: timestamp, host, app, pid, message.
SYSLOG_PATTERN = r"^(\w{3}\s+\d+\s\d{2}:\d{2}:\d{2})\s(\S+)\s(\S+)\[(\d+)]:\s(.*)"
SYSLOG_FIELDS = ("timestamp", "hostname", "appname", "pid", "message")

# IPv6 literal (full, `::`-compressed, link-local with zone, v4-mapped and
# v4-embedded forms). Used anchored, on the trimmed cell.
IPV6_PATTERN = (
    "(([0-9a-fA-F]{1,4}:){7,7}[0-9a-fA-F]{1,4}|([0-9a-fA-F]{1,4}:){1,7}:|([0-9a-fA-F]{1,4}:){1,6}:[0-9a-fA-F]{1,4}|"
    "([0-9a-fA-F]{1,4}:){1,5}(:[0-9a-fA-F]{1,4}){1,2}|([0-9a-fA-F]{1,4}:){1,4}(:[0-9a-fA-F]{1,4}){1,3}|"
    "([0-9a-fA-F]{1,4}:){1,3}(:[0-9a-fA-F]{1,4}){1,4}|([0-9a-fA-F]{1,4}:){1,2}(:[0-9a-fA-F]{1,4}){1,5}|"
    "[0-9a-fA-F]{1,4}:((:[0-9a-fA-F]{1,4}){1,6})|:((:[0-9a-fA-F]{1,4}){1,7}|:)|"
    "fe80:(:[0-9a-fA-F]{0,4}){0,4}%[0-9a-zA-Z]{1,}|"
    "::(ffff(:0{1,4}){0,1}:){0,1}((25[0-5]|(2[0-4]|1{0,1}[0-9]){0,1}[0-9])\\.){3,3}(25[0-5]|(2[0-4]|1{0,1}[0-9]){0,1}[0-9])|"
    "([0-9a-fA-F]{1,4}:){1,4}:((25[0-5]|(2[0-4]|1{0,1}[0-9]){0,1}[0-9])\\.){3,3}(25[0-5]|(2[0-4]|1{0,1}[0-9]){0,1}[0-9]))"
)

# Policy used when the caller asks for the default instead of a file:
# 192.168.1.0 - 192.168.1.254 and 10.0.19.0 - 10.0.19.254, no IPv6 rule.
DEFAULT_POLICY_LINES = ("192.168.1.0,192.168.1.254", "10.0.19.0,10.0.19.254")

# TF-IDF model parameters.
VOCAB_SIZE = 125
MIN_DOC_FREQ = 2

# ---------------------------------------------------------------------------
# end of FIXED VALUES
# ---------------------------------------------------------------------------

ENVELOPE = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("timestampType", T.IntegerType()),
])

SYSLOG = T.StructType([T.StructField(n, T.StringType()) for n in SYSLOG_FIELDS])

FEATURE_TYPES = {
    "tpkt": T.LongType(),
    "tbyt": T.DoubleType(),
    **{name: T.IntegerType() for name in DERIVED_COLUMNS if name not in ("tpkt", "tbyt")},
}


def flow_columns(header: str | None = None) -> list[str]:
    """Cell names from a header line (comma separated); the default header if None.

    Names are trimmed; an empty or duplicate name is an error because every
    later step resolves cells by name.
    """
    line = DEFAULT_FLOW_HEADER if header is None else header.strip().splitlines()[0]
    names = [n.strip() for n in line.split(",")]
    if any(not n for n in names):
        raise ValueError(f"empty column name in flow header: {line!r}")
    if len(set(names)) != len(names):
        raise ValueError(f"duplicate column name in flow header: {line!r}")
    return names


def read_flow_header(spark, path: str | None) -> list[str]:
    """Flow cell names from the first line of a header file.

    ``path=None`` gives the default header. The file is a one-line config
    file, read through Spark so it may live on any cluster filesystem.
    """
    if path is None:
        return flow_columns(None)
    first = spark.read.text(path).limit(1).collect()
    if not first:
        raise ValueError(f"flow header file is empty: {path}")
    return flow_columns(first[0][0])
