"""Telemetry classification rules (T-1 to T-9) applied to real rows.

The lookup lists are small fixed literals, compiled into ``isin`` / map
lookups inside the projection (no join, no shuffle, whole-stage codegen).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions import severity as sev

# --- FIXED VALUES: network ports and services -------------------------------------------------
COMMON_PORTS = [22, 80, 443, 3306, 5432, 6379, 27017, 25, 110, 143, 993, 995, 8080, 8443, 9200, 11211]
WATCHLIST_PORTS = [4444, 1337, 6667, 31337, 12345, 54321, 3389, 8088, 9001, 9050, 2222, 50050]
COMMON_SERVICES = [
    (80, "http", "nginx"), (443, "https", "envoy"), (22, "ssh", "openssh"), (3306, "mysql", "mysqld"),
    (5432, "postgres", "postgres"), (6379, "redis", "redis-server"), (27017, "mongodb", "mongod"),
    (9200, "elasticsearch", "java"), (11211, "memcached", "memcached"), (25, "smtp", "postfix"),
    (8080, "http-alt", "jetty"), (8443, "https-alt", "tomcat"),
]

# --- FIXED VALUES: DNS watch-list -------------------------------------------------------------
WATCHLIST_DOMAINS = ["cnc.example.net", "steal-data.co", "updates.badcorp.ru", "dropper.mal", "cryptominer.pool"]
SUSPECT_TLDS = [".ru", ".cn", ".tk", ".top", ".xyz"]

# --- FIXED VALUES: kernel module classes (lists overlap; precedence below) --------------------
NORMAL_MODULES = ["i915", "nvme", "xhci_pci", "snd_hda_intel", "iwlwifi", "btusb", "usb_storage", "ahci", "sd_mod",
                  "ext4", "btrfs", "xfs", "vfat", "nls_utf8", "crc32c_generic", "aesni_intel", "cryptd",
                  "ghash_clmulni_intel", "zram", "coretemp", "kvm_intel", "kvm", "vfio", "vfio_pci"]
UNNECESSARY_MODULES = ["bluetooth", "rfcomm", "bnep", "hidp", "sco", "rfkill", "cfg80211", "mac80211", "iwlmvm", "wl",
                       "rt2800usb", "rt2x00usb", "carl9170", "ath9k", "ath5k", "firewire_core", "firewire_ohci",
                       "firewire_sbp2", "dv1394", "raw1394", "video1394", "ohci1394", "sbp2", "eth1394"]
ATTACK_SURFACE_MODULES = ["cramfs", "freevxfs", "jffs2", "hfs", "hfsplus", "squashfs", "udf", "vfat", "usb_storage",
                          "firewire_core", "sctp", "rds", "tipc", "dccp", "usb_8dev", "can_dev", "can_raw", "can_bcm",
                          "veth", "macvlan", "ipvlan"]
DEBUG_MODULES = ["msr", "cpuid", "kvm", "kvm_intel", "kvm_amd", "vfio", "vfio_pci", "vfio_iommu_type1", "vfio_virqfd",
                 "uio", "uio_pci_generic", "igb_uio", "rte_kni", "dpdk", "xdp", "bpf", "ebpf", "trace", "kprobes"]
# class -> (severity, risk), in precedence order (most severe first)
MODULE_CLASSES = [("attack_surface", ATTACK_SURFACE_MODULES, "high", 70),
                  ("debug", DEBUG_MODULES, "medium", 45),
                  ("unnecessary", UNNECESSARY_MODULES, "low", 25),
                  ("normal", NORMAL_MODULES, "info", 10)]


def port_class(port: Column) -> DataFrame:
    """T-4: common / watch_listed / other."""
    return (F.when(port.isin(*COMMON_PORTS), "common").when(port.isin(*WATCHLIST_PORTS), "watch_listed")
            .otherwise("other"))


def classify_ports(df: DataFrame, port_col: str = "port") -> DataFrame:
    """T-4 with the service and process for common services (null otherwise)."""
    svc = sev.lookup({p: s for p, s, _ in COMMON_SERVICES}, F.col(port_col))
    proc = sev.lookup({p: pr for p, _, pr in COMMON_SERVICES}, F.col(port_col))
    return df.withColumn("port_class", port_class(F.col(port_col))).withColumn("service", svc) \
        .withColumn("service_process", proc)


def classify_domains(df: DataFrame, url_col: str = "url") -> DataFrame:
    """T-5: host of the URL on the watch-list -> medium/55; ending in a suspect TLD -> low/28; else info/12."""
    host = F.lower(F.parse_url(F.col(url_col), F.lit("HOST")))
    watch = host.isin(*WATCHLIST_DOMAINS)
    tld = F.lit(False)
    for t in SUSPECT_TLDS:
        tld = tld | F.coalesce(host.endswith(t), F.lit(False))
    cls = F.when(watch, "watch_listed").when(tld, "suspect_tld").otherwise("normal")
    return (df.withColumn("domain", host).withColumn("dns_class", cls)
            .withColumn("severity", F.when(watch, "medium").when(tld, "low").otherwise("info"))
            .withColumn("risk_score", F.when(watch, F.lit(55.0)).when(tld, F.lit(28.0)).otherwise(F.lit(12.0))))


def module_name(title: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(F.coalesce(title, F.lit("")), "^Module ", "")))


def classify_modules(df: DataFrame) -> DataFrame:
    """T-6: first matching class by precedence (lists overlap, e.g. vfat, kvm); unlisted -> other/info/10."""
    name = module_name(F.col("title"))
    cls = sv = rk = None
    for c, names, s, r in MODULE_CLASSES:
        hit = name.isin(*names)
        cls = F.when(hit, c) if cls is None else cls.when(hit, c)
        sv = F.when(hit, s) if sv is None else sv.when(hit, s)
        rk = F.when(hit, float(r)) if rk is None else rk.when(hit, float(r))
    return (df.withColumn("module", name).withColumn("module_class", cls.otherwise("other"))
            .withColumn("class_severity", sv.otherwise("info")).withColumn("class_risk", rk.otherwise(10.0)))


def apparmor_posture(df: DataFrame) -> DataFrame:
    """T-2 (AppArmor): disabled or any unconfined critical profile -> medium/50, else low/30."""
    enabled = F.get_json_object(F.col("metadata"), "$.enabled")
    unconf = F.coalesce(F.get_json_object(F.col("metadata"), "$.unconfined_critical").try_cast("int"), F.lit(0))
    bad = (F.coalesce(enabled, F.lit("")) != "true") | (unconf > 0)
    return (df.withColumn("posture_severity", F.when(bad, "medium").otherwise("low"))
            .withColumn("posture_risk", F.when(bad, F.lit(50.0)).otherwise(F.lit(30.0))))


# --- FIXED VALUES: (severity, risk) of a security module that is absent, present but off, and on -----------------
MAC_POSTURES = {
    "selinux": (("low", 30.0), ("medium", 50.0), ("info", 10.0)),
    "grsecurity": (("info", 10.0), ("high", 80.0), ("low", 25.0)),
    "tomoyo": (("info", 10.0), ("medium", 45.0), ("low", 25.0)),
}
# --- FIXED VALUES: kernel parameters that should be 0; all others should be 1 --------------------------------------
ZERO_PARAMETERS = ["ip_forward", "accept_source_route", "accept_redirects", "secure_redirects"]


def mac_posture(df: DataFrame, module: str = "module", present: str = "present", enabled: str = "enabled") -> DataFrame:
    """T-2 (the other three tables): severity and risk by whether the module is present and enabled."""
    state = F.when(~F.col(present), 0).when(~F.col(enabled), 1).otherwise(2)
    sv = rk = None
    for name, levels in MAC_POSTURES.items():
        for i, (s, r) in enumerate(levels):
            hit = (F.col(module) == name) & (state == i)
            sv = F.when(hit, s) if sv is None else sv.when(hit, s)
            rk = F.when(hit, r) if rk is None else rk.when(hit, r)
    return df.withColumn("posture_severity", sv).withColumn("posture_risk", rk)


def parameter_drift(df: DataFrame, name: str = "name", current: str = "current") -> DataFrame:
    """T-1: a parameter's desired value, whether the current one is it (as text), and its severity (as numbers)."""
    desired = F.when(F.col(name).isin(*ZERO_PARAMETERS), "0").otherwise("1")
    number = F.when(F.col(current).rlike("^[0-9]+$"), F.col(current).cast("long")).otherwise(0)
    same = number == desired.cast("long")
    return (df.withColumn("desired", desired)
            .withColumn("status", F.when(F.col(current) == desired, "ok").otherwise("mismatch"))
            .withColumn("drift_severity", F.when(same, "low").otherwise("medium"))
            .withColumn("drift_risk", F.when(same, F.lit(30.0)).otherwise(F.lit(50.0))))


def suid_flag(df: DataFrame, expected: str = "expected") -> DataFrame:
    """T-3: an expected SUID binary is low/30, any other medium/50."""
    ok = F.coalesce(F.col(expected), F.lit(False))
    return (df.withColumn("suid_severity", F.when(ok, "low").otherwise("medium"))
            .withColumn("suid_risk", F.when(ok, F.lit(30.0)).otherwise(F.lit(50.0))))


# --- FIXED VALUES: paths by class, (severity, risk) by class -------------------------------------------------------
PROCESS_PATHS = {
    "normal": ["/usr/sbin/sshd", "/usr/bin/bash", "/usr/bin/python3", "/usr/sbin/apache2", "/usr/bin/dockerd",
               "/usr/sbin/mysqld", "/usr/bin/node", "/usr/bin/java", "/usr/bin/systemd", "/usr/sbin/cron",
               "/usr/bin/gnome-shell", "/usr/bin/firefox"],
    "malicious": ["/tmp/.evil", "/tmp/malicious", "/var/tmp/backdoor", "/home/*/.config", "/home/*/.hidden",
                  "/usr/local/bin", "/opt/evil"],
    "edge_case": ["/proc/self/exe", "/dev/null"],
}
PROCESS_LEVELS = {"normal": ("info", 10.0), "edge_case": ("low", 30.0), "suspicious": ("medium", 50.0),
                  "malicious": ("high", 80.0)}
WRITABLE_PATHS = {
    "normal": ["/tmp", "/var/tmp", "/dev/shm", "/run/user", "/var/log"],
    "suspicious": ["/etc/passwd.backup", "/etc/shadow.backup", "/var/www/html", "/home/*/.ssh/authorized_keys",
                   "/usr/local/bin"],
    "malicious": ["/etc/passwd", "/etc/shadow", "/etc/sudoers", "/root/.ssh/authorized_keys", "/usr/bin/sudo", "/bin/su"],
}
WRITABLE_LEVELS = {"normal": ("info", 10.0), "suspicious": ("medium", 50.0), "malicious": ("high", 80.0),
                   "file_capability": ("medium", 50.0)}
IOC_LEVELS = {"deleted_executable": ("critical", 90.0), "world_writable_executable": ("high", 70.0),
              "malicious": ("high", 80.0), "suspicious": ("low", 30.0), "normal": ("info", 10.0)}
#: Commands that listen, connect out or fetch: suspicious as processes.
SUSPICIOUS_COMMAND = r"(/|^)nc -l|/dev/tcp/|import socket|(/|^)(wget|curl) https?://"
#: Commands that hand a shell or a fetched program over: malicious as indicators.
MALICIOUS_COMMAND = r"/dev/tcp/|import socket|\| *(ba)?sh\b|chmod \+x|(/|^)nc -e"
LONG_COMMAND = 1000


def longest_prefix(path: Column, table: dict[str, list[str]]) -> Column:
    """The class whose listed path is the longest that ``path`` equals or lies under; null when there is none.

    A path is expanded to its leading parts, longest first and no deeper than the table, and each part is looked up in
    a literal map: no join, no shuffle, and a cost bound by the table's depth. ``*`` stands for the user under /home.
    """
    flat = {p: c for c, paths in table.items() for p in paths}
    deepest = max(p.count("/") for p in flat) + 1
    parts = F.split(F.regexp_replace(path, "^/home/[^/]+", "/home/*"), "/")
    known = F.create_map(*[F.lit(x) for pair in flat.items() for x in pair])
    depths = F.sequence(F.least(F.size(parts), F.lit(deepest)), F.lit(1), F.lit(-1))
    hits = F.transform(depths, lambda n: F.try_element_at(known, F.array_join(F.slice(parts, F.lit(1), n), "/")))
    return F.get(F.filter(hits, lambda c: c.isNotNull()), 0)


def _levels(df: DataFrame, cls: Column, name: str, levels: dict[str, tuple[str, float]]) -> DataFrame:
    default = levels["normal"]
    return (df.withColumn(name, cls)
            .withColumn("class_severity", F.coalesce(sev.lookup({k: s for k, (s, _) in levels.items()}, F.col(name)), F.lit(default[0])))
            .withColumn("class_risk", F.coalesce(sev.lookup({k: r for k, (_, r) in levels.items()}, F.col(name)), F.lit(default[1]))))


def classify_processes(df: DataFrame, command: str = "command") -> DataFrame:
    """T-9: the class of a process by its command. No, very long and kernel-path commands are edge cases; then a
    malicious place, a suspicious command, a known place; anything else is ``other`` at the normal level."""
    text = F.coalesce(F.col(command), F.lit(""))
    place = longest_prefix(F.substring_index(text, " ", 1), PROCESS_PATHS)
    cls = (F.when((text == "") | (F.length(text) >= LONG_COMMAND) | (place == "edge_case"), "edge_case")
           .when(place == "malicious", place).when(text.rlike(SUSPICIOUS_COMMAND), "suspicious")
           .otherwise(F.coalesce(place, F.lit("other"))))
    return _levels(df, cls, "process_class", PROCESS_LEVELS)


def classify_indicators(df: DataFrame, metadata: str = "metadata") -> DataFrame:
    """T-8: a process indicator by its flags (true as text or boolean) and, where a pattern matched, its command."""
    parsed = F.from_json(F.col(metadata), "deleted_executable string, world_writable_executable string, "
                                          "pattern_match string, command string")
    rows = df.withColumn("_flags", parsed)

    def flag(key: str) -> Column:
        return F.lower(F.coalesce(F.col("_flags")[key], F.lit(""))) == "true"
    shell = F.coalesce(F.col("_flags.command"), F.lit("")).rlike(MALICIOUS_COMMAND)
    cls = (F.when(flag("deleted_executable"), "deleted_executable")
           .when(flag("world_writable_executable"), "world_writable_executable")
           .when(flag("pattern_match") & shell, "malicious").when(flag("pattern_match"), "suspicious").otherwise("normal"))
    return _levels(rows, cls, "ioc_class", IOC_LEVELS).drop("_flags")


def classify_file_modes(df: DataFrame, path: str = "path", rule: str = "rule") -> DataFrame:
    """T-7: a world-writable file by its path, unless the rule names file capabilities; unlisted paths are ``other`` at
    the normal level."""
    cls = F.when(F.col(rule) == "file_capability", "file_capability").otherwise(
        F.coalesce(longest_prefix(F.coalesce(F.col(path), F.lit("")), WRITABLE_PATHS), F.lit("other")))
    return _levels(df, cls, "mode_class", WRITABLE_LEVELS)
