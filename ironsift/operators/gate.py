"""Viability gate: the first rule that holds rejects an item and says why."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rejection reasons in the order of their rules, names of subsystems, the module names that count as kernel imports.
REASONS = ("blacklisted", "corrupted", "not-pe", "corrupted", "wrong-subsystem", "kernel-imports-unresolved", "signature-policy-mismatch", "packed-unknown")
SUBSYSTEMS = {
    0: "UNKNOWN", 1: "NATIVE", 2: "WINDOWS_GUI", 3: "WINDOWS_CUI", 5: "OS2_CUI", 7: "POSIX_CUI", 9: "WINDOWS_CE_GUI", 10: "EFI_APPLICATION",
    11: "EFI_BOOT_SERVICE_DRIVER", 12: "EFI_RUNTIME_DRIVER", 13: "EFI_ROM", 14: "XBOX", 16: "WINDOWS_BOOT_APPLICATION",
}
KERNEL_MODULES = (
    "ntoskrnl.exe", "ntkrnlpa.exe", "ntkrnlmp.exe", "ntkrpamp.exe", "hal.dll", "wdfldr.sys", "wdfldr.dll", "wdmaud.sys", "ndis.sys", "fltmgr.sys", "ksecdd.sys",
    "storport.sys", "scsiport.sys", "usbd.sys", "wmilib.sys", "ks.sys", "portcls.sys", "tcpip.sys", "netio.sys", "classpnp.sys", "videoprt.sys", "dxgkrnl.sys",
    "bootvid.dll", "pshed.dll", "clfs.sys", "cng.sys", "msrpc.sys",
)
NATIVE = 1
PACKED = 7.5


def _text(*parts: Column | str) -> Column:
    return F.concat(*(F.lit(x) if isinstance(x, str) else x.cast("string") for x in parts))


def gate(headers: DataFrame, blocklist: DataFrame, policy: str = "any", kernel_modules: tuple[str, ...] = KERNEL_MODULES) -> DataFrame:
    """Adds reason and reason_detail, both null where the item is accepted.

    headers: item, size, machine, subsystem, has_signature, modules (array, in order), and sections (array of structs with
    name, raw_ptr, raw_size, executable, entropy). Items and the blocklist's compare in lower case. policy: any, or present
    (an item without a signature is rejected).
    """
    blocked = blocklist.select(F.lower(F.col("item").cast("string")).alias("_key"), F.lit(True).alias("blocked")).distinct()
    df = headers.withColumn("_key", F.lower(F.col("item").cast("string"))).join(blocked, "_key", "left").drop("_key")
    code = F.filter("sections", lambda s: s["executable"])
    beyond = F.get(F.filter("sections", lambda s: (s["raw_size"] > 0) & (s["raw_ptr"] + s["raw_size"] > F.col("size"))), F.lit(0))
    modules = F.coalesce("modules", F.array().cast("array<string>"))
    known = F.exists(modules, lambda m: F.lower(m).isin(*kernel_modules))
    subsystem = F.coalesce(F.element_at(F.create_map(*(F.lit(x) for pair in SUBSYSTEMS.items() for x in pair)), F.col("subsystem").cast("int")), F.lit("UNKNOWN"))
    modules_text = F.when(F.size(modules) == 0, "nothing is imported").otherwise(_text("no kernel module among the imports, which begin with ", F.lower(F.get(modules, F.lit(0)))))
    rules = [
        (F.col("blocked"), F.lit("on the blocklist")),
        (F.col("size") == 0, F.lit("no content")),
        (F.col("machine").isNull(), F.lit("no readable header")),
        (beyond.isNotNull(), _text("section ", beyond["name"], " reaches to ", (beyond["raw_ptr"] + beyond["raw_size"]).cast("long"), " in a file of ", F.col("size").cast("long"))),
        (F.col("subsystem") != NATIVE, _text("subsystem ", F.col("subsystem"), ", ", subsystem, f", isn't {NATIVE}")),
        (~known, modules_text),
        (F.lit(policy == "present") & ~F.col("has_signature"), F.lit("the policy asks for a signature")),
        ((F.size(code) > 0) & F.forall(code, lambda s: s["entropy"] > PACKED), _text("code of an entropy up to ", F.format_number(F.array_max(F.transform(code, lambda s: s["entropy"])), 2), f", all over {PACKED}")),
    ]
    reason = F.coalesce(*(F.when(test, F.lit(r)) for (test, _), r in zip(rules, REASONS, strict=True)))
    detail = F.coalesce(*(F.when(test, text) for test, text in rules))
    return df.withColumns({"reason": reason, "detail": detail}).withColumn("reason_detail", cut_detail("detail", "reason")).drop("blocked", "detail")


def cut_detail(detail: str, reason: str) -> Column:
    """The detail of a rejection, or else its reason, 500 characters at most; null where there is no reason."""
    return F.when(F.col(reason).isNotNull(), F.left(F.coalesce(F.nullif(detail, F.lit("")), reason), F.lit(500)))


def rejected_rows(gated: DataFrame) -> DataFrame:
    """item, reason, reason_detail and size_bytes (null for none) of the items that the gate rejects."""
    return gated.filter("reason IS NOT NULL").select("item", "reason", "reason_detail", F.nullif("size", F.lit(0)).alias("size_bytes"))


def rejections_by_reason(gated: DataFrame) -> DataFrame:
    return gated.filter("reason IS NOT NULL").groupBy("reason").agg(F.count("*").alias("n"))
