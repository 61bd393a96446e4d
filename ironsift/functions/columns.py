"""Column functions: normalisation of codes, addresses, names and statuses. None uses Python on the rows."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Machine codes, severities, sources by dispatch method, device classes, kinds of sources by trust, names of checks.
ARCH = {0x14C: "x86", 0x8664: "x64", 0xAA64: "arm64"}
SEVERITY = {"CRITICAL": 4, "HIGH": 3, "MEDIUM": 2, "LOW": 1, "INFO": 0}
SOURCE_BY_METHOD = {
    "METHOD_BUFFERED": "IRP->AssociatedIrp.SystemBuffer",
    "METHOD_IN_DIRECT": "IRP->MdlAddress (direct I/O) + SystemBuffer",
    "METHOD_OUT_DIRECT": "IRP->MdlAddress (direct I/O) + SystemBuffer",
    "METHOD_NEITHER": "IRP->UserBuffer / Type3InputBuffer (raw, unvalidated user pointers)",
}
UNRESOLVED_SOURCE = "user-controlled IRP input (method unresolved)"
DEVICE_CLASSES = [
    ("PhysicalMemory|Phy|MapIo", "memory"),
    (r"\\Hid|\\Kbd|\\Mou", "hid"),
    (r"\\DISK|\\Volume|\\CdRom|Nvme|Scsi", "disk"),
    (r"\\Nd|\\Tcp|\\Udp|\\Ip", "net"),
    (r"\\Usb", "usb"),
    (r"\\Beep|\\Null|\\Rand", "generic"),
]
TRUST = {"dell-oem-catalog": "first_party", "techpowerup-mirror": "mirror", "aggregator-rehost": "aggregator", "samlab-rehost": "re_host", "cpuid-embedded": "embedded"}
ENTRY_SIGNATURE = "NTSTATUS DriverEntry(PDRIVER_OBJECT, PUNICODE_STRING)"
DISPATCH_SIGNATURE = "NTSTATUS (PDEVICE_OBJECT DeviceObject, PIRP Irp)"
#: Texts of which one names a check; for the input length a text of each of two kinds together does too.
CHECK_TEXTS = {
    "ProbeForRead": ("probeforread", "probe for read"),
    "ProbeForWrite": ("probeforwrite", "probe for write"),
    "input_length_check": ("inputbufferlength", "input length"),
    "output_length_check": ("outputbufferlength", "output length"),
    "caller_privilege_check": ("privilege", "sedebug", "administrator", "integrity", "token"),
}
INPUT_LENGTH_TOGETHER = ("input buffer", "length")


def _lookup(values: dict, key: Column) -> Column:
    return F.element_at(F.create_map(*(F.lit(x) for pair in values.items() for x in pair)), key)


def hex_codes(codes: Column) -> Column:
    """0x and lower-case digits of each base-16 string; what is no code goes, repeats too, order stays."""
    good = F.filter(codes, lambda c: c.rlike("^(0[xX])?[0-9a-fA-F]+$"))
    plain = F.transform(good, lambda c: F.concat(F.lit("0x"), F.lower(F.hex(F.conv(F.regexp_replace(c, "^0[xX]", ""), 16, 10).cast("decimal(20,0)").cast("long")))))
    return F.array_distinct(plain)


def absolute_url(url: Column, base: str) -> Column:
    url = F.replace(F.replace(url, F.lit("&amp;"), F.lit("&")), F.lit("&quot;"), F.lit('"'))
    full = F.when(url.startswith("//"), F.concat(F.lit("https:"), url)).when(url.startswith("/"), F.concat(F.lit(base.rstrip("/")), url)).otherwise(url)
    return F.regexp_replace(full, "^http://", "https://")


def query_parameter(url: Column, name: str) -> Column:
    """Percent-decoded value of a parameter; a plus stays a plus; null where absent."""
    raw = F.nullif(F.regexp_extract(url, rf"[?&]{name}=([^&#]*)", 1), F.lit(""))
    return F.try_url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))


def token(url: Column) -> Column:
    """A download token: the t parameter, or else what follows /dl/."""
    return F.coalesce(query_parameter(url, "t"), F.nullif(F.regexp_extract(url, r"/dl/([^/?#]+)", 1), F.lit("")))


def title_of_slug(url: Column) -> Column:
    """The title in a landing address: what follows the folder after the first "/_", with dashes as blanks and without the
    words that every slug has. Another address, or an empty title, is the title itself."""
    tail = F.regexp_extract(url, "(?s)/_(.*)$", 1)
    part = F.when(F.contains(tail, F.lit("/")), F.regexp_extract(tail, "(?s)^[^/]*/(.*)$", 1)).otherwise(tail)
    part = F.coalesce(F.try_url_decode(F.replace(part, F.lit("+"), F.lit("%2B"))), part)
    title = F.trim(F.replace(F.replace(F.replace(part, F.lit("Download-"), F.lit("")), F.lit("-free"), F.lit("")), F.lit("-"), F.lit(" ")))
    return F.when(F.contains(url, F.lit("/_")), F.coalesce(F.nullif(title, F.lit("")), url)).otherwise(url)


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]+)", 1))


def base_name(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(F.try_url_decode(F.replace(F.regexp_replace(url, r"[?#].*$", ""), F.lit("+"), F.lit("%2B"))), url), "[^/]+$", 0)


def extension(name: Column) -> Column:
    return F.lower(F.regexp_extract(name, r"\.([A-Za-z0-9]+)$", 1))


def size_bytes(text: Column) -> Column:
    """Bytes of a size such as 12.3 MB, in binary units, cut to whole bytes."""
    units = _lookup({"B": 1, "KB": 1 << 10, "MB": 1 << 20, "GB": 1 << 30}, F.upper(F.regexp_extract(text, r"([0-9.]+)\s*([KMGkmg]?[Bb])", 2)))
    return F.floor(F.regexp_extract(text, r"([0-9]+(?:\.[0-9]+)?)\s*([KMGkmg]?[Bb])", 1).try_cast("double") * units).cast("long")


def slug(text: Column, default: str = "fn") -> Column:
    clean = F.lower(F.regexp_replace(F.regexp_replace(text, "[^A-Za-z0-9]+", "_"), "^_+|_+$", ""))
    return F.when(clean == "", F.lit(default)).otherwise(F.coalesce(clean, F.lit(default)))


def little_endian(content: Column, at: Column, size: int) -> Column:
    """The unsigned number of some bytes at an offset; null beyond the end."""
    part = F.substring(F.hex(content), at * 2 + 1, F.lit(2 * size))
    swapped = F.concat(*(F.substring(part, F.lit(2 * k + 1), F.lit(2)) for k in reversed(range(size))))
    return F.when(F.char_length(part) == 2 * size, F.conv(swapped, 16, 10).cast("long"))


def arch(machine: Column) -> Column:
    """The architecture of a machine code, null for another code."""
    return _lookup(ARCH, machine.cast("int"))


def run_id(ts: Column, short: str) -> Column:
    return F.concat(F.date_format(ts, "yyyyMMdd'T'HHmmss'Z-'"), F.lit(short))


def iso_utc(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def split_list(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, "[;,]"), lambda x: F.trim(x)), lambda x: x != "")


def catalogued(symbols: Column, catalog_lower: Column) -> Column:
    """The symbols (own casing, sorted, distinct) whose lower-case form is in the catalog."""
    return F.array_sort(F.array_distinct(F.filter(symbols, lambda s: F.array_contains(catalog_lower, F.lower(s)))))


def truncate(text: Column, n: int) -> Column:
    return F.left(text, F.lit(n))


def or_empty(array: Column) -> Column:
    return F.coalesce(array, F.array().cast("array<string>"))


def unit_key(url: Column) -> Column:
    return F.left(F.sha2(url.cast("binary"), 256), F.lit(16))


def trust_tier(kind: Column) -> Column:
    return F.coalesce(_lookup(TRUST, kind), F.lit("unknown"))


def signature_text(name: Column, is_entry: Column) -> Column:
    """How a function of this class of name is declared; null where its shape is not known."""
    return F.when(is_entry, ENTRY_SIGNATURE).when(name.startswith("IRP_MJ_"), DISPATCH_SIGNATURE)


def source_text(method: Column) -> Column:
    """Where the input of a request comes from, by its method."""
    return F.coalesce(_lookup(SOURCE_BY_METHOD, F.coalesce(method, F.lit(""))), F.lit(UNRESOLVED_SOURCE))


def severity_order(severity: Column) -> Column:
    return F.coalesce(_lookup(SEVERITY, F.upper(severity)), F.lit(0)).cast("long")


def signature_status(signed: Column, expired: Column) -> Column:
    return F.when(~F.coalesce(signed, F.lit(False)), "unsigned").when(F.coalesce(expired, F.lit(False)), "expired").otherwise("signed")


def collected_signature_status(accepted: Column) -> Column:
    """The same for a collector's own check, which may be missing."""
    return F.when(accepted, "signed").when(~accepted, "unsigned").otherwise("unknown")


def pick_cve(cves: Column, tags: Column) -> Column:
    """The CVE of the first non-empty entry, or else of the first tag that has one, upper-case; or null."""
    find = lambda x: F.nullif(F.upper(F.regexp_extract(x, r"(?i)CVE-\d{4}-\d{3,7}", 0)), F.lit(""))
    first = find(F.get(F.filter(cves, lambda x: x != ""), F.lit(0)))
    return F.coalesce(first, F.get(F.filter(F.transform(tags, find), lambda x: x.isNotNull()), F.lit(0)))


def device_buckets(names: Column, rules: list[tuple[str, str]] | None = None) -> Column:
    """Sorted classes with a pattern that finds any name; generic where names exist and none is found."""
    found = lambda pattern: F.exists(names, lambda n: n.rlike("(?i)" + pattern))
    hit = F.array_compact(F.array(*(F.when(found(p), F.lit(c)) for p, c in rules or DEVICE_CLASSES)))
    return F.when(F.size(hit) > 0, F.array_sort(F.array_distinct(hit))).when(F.size(names) > 0, F.array(F.lit("generic"))).otherwise(F.array().cast("array<string>"))


def _has(text: Column, *words: str) -> Column:
    return F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(text, w))


def present_checks(lines: Column) -> Column:
    """The checks that free text names clearly."""
    text = F.lower(F.array_join(F.coalesce(lines, F.array().cast("array<string>")), " "))
    rules = {check: _has(text, *texts) for check, texts in CHECK_TEXTS.items()}
    rules["input_length_check"] |= reduce(and_, (_has(text, x) for x in INPUT_LENGTH_TOGETHER))
    return F.array_compact(F.array(*(F.when(v, F.lit(k)) for k, v in rules.items())))


def expected_checks(method: Column, has_sink: Column) -> Column:
    """The checks that a request of this method ought to make, given whether it reaches a sink."""
    none = F.array().cast("array<string>")
    sink = F.when(has_sink, F.array(F.lit("input_length_check"), F.lit("caller_privilege_check"))).otherwise(none)
    raw = F.when(method == "METHOD_NEITHER", F.array(F.lit("ProbeForRead"), F.lit("ProbeForWrite"), F.lit("input_length_check"))).otherwise(none)
    return F.array_union(sink, raw)


def gaps(present: Column, method: Column, has_sink: Column) -> Column:
    """Expected checks that are missing, sorted. Either narrower check of the caller implies the broad one."""
    narrow = F.arrays_overlap(present, F.array(F.lit("caller_integrity_check"), F.lit("caller_sid_check")))
    whole = F.when(narrow, F.array_union(present, F.array(F.lit("caller_privilege_check")))).otherwise(present)
    return F.array_sort(F.array_except(expected_checks(method, has_sink), whole))


def common(a: Column, b: Column) -> Column:
    return F.array_sort(F.array_intersect(a, b))


def lacking(wanted: Column, have: Column) -> Column:
    return F.array_sort(F.array_except(wanted, have))


def united(a: Column, b: Column) -> Column:
    return F.array_sort(F.array_union(a, b))
