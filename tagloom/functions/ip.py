"""IPv4 text, numbers, and the place names of IP records."""

from pyspark.sql import Column, functions as F

# Texts for addresses without a record and for the local network.
UNKNOWN_COUNTRY = "未知国家"
UNKNOWN_AREA = "未知地区"
LOCAL_MARK = "CZ88.NET"
LOCAL_AREA = "本机或本网络"
PROVINCE_SUFFIX = "省"

_OCTET = r"0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_DOTTED = rf"^{_OCTET}(\.{_OCTET}){{3}}$"


def ip_to_long(ip) -> Column:
    """Dotted address as BIGINT; NULL if it is not a valid one."""
    octets = [F.split_part(ip, F.lit("."), F.lit(i + 1)).cast("bigint") for i in range(4)]
    number = sum((octet * (1 << (8 * (3 - i))) for i, octet in enumerate(octets)), F.lit(0))
    return F.when(F.rlike(ip, F.lit(_DOTTED)), number)


def long_to_ip(number) -> Column:
    """BIGINT as dotted address; NULL outside of 32 bits."""
    octets = [F.shiftright(number, 8 * i).bitwiseAND(255).cast("string") for i in (3, 2, 1, 0)]
    return F.when(number.between(0, (1 << 32) - 1), F.concat_ws(".", *octets))


def _has_city(country) -> Column:
    return F.rlike(country, F.lit(f"{PROVINCE_SUFFIX}.*[^{PROVINCE_SUFFIX}]"))


def _part(country, number) -> Column:
    return F.split_part(country, F.lit(PROVINCE_SUFFIX), F.lit(number))


def province_of(country) -> Column:
    """`A省B市` gives `A省`; text without anything after 省 stays whole."""
    province = F.concat(_part(country, 1), F.lit(PROVINCE_SUFFIX))
    return F.when(_has_city(country), province).otherwise(country)


def city_of(country) -> Column:
    """`A省B市` gives `B市`; text without anything after 省 stays whole."""
    return F.when(_has_city(country), _part(country, 2)).otherwise(country)


def clean_area(area) -> Column:
    return F.when(F.trim(area) == LOCAL_MARK, F.lit(LOCAL_AREA)).otherwise(area)


def is_private(ip) -> Column:
    return F.startswith(ip, F.lit("192.168."))
