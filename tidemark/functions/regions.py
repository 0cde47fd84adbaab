"""Countries and regions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Countries by region, in English and in Chinese.
COUNTRIES = {
    "NORTH AMERICA": ["US", "USA", "UNITED STATES", "美国", "CANADA", "CA", "加拿大", "MEXICO", "MX", "墨西哥"],
    "SOUTH AMERICA": ["BRAZIL", "巴西", "CHILE", "智利", "COLOMBIA", "哥伦比亚", "PERU", "秘鲁", "ARGENTINA", "阿根廷"],
    "EUROPE": ["GERMANY", "德国", "FRANCE", "法国", "SPAIN", "西班牙", "ITALY", "意大利", "UNITED KINGDOM", "UK", "英国", "POLAND", "波兰"],
    "ASIA": ["JAPAN", "JP", "日本", "KOREA", "韩国", "TURKEY", "土耳其", "THAILAND", "泰国"],
}


def region(country: Column) -> Column:
    """Region of a country; a country that is not listed is UNKNOWN, never a default region."""
    name, out = F.upper(F.trim(country)), F.lit("UNKNOWN")
    for where, names in COUNTRIES.items():
        out = F.when(name.isin(*names), where).otherwise(out)
    return out
