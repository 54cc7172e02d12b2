"""Administrative units of the Empire: provinces with their years, districts of the four provinces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .functions import fields as D
from .operators.search import inline

# Provinces, the first and the last year of each.
PROVINCES = (
    ("Санкт-Петербургская губерния", 1708, 1929), ("Новгородская губерния", 1727, 1927), ("Псковская губерния", 1772, 1927),
    ("Олонецкая губерния", 1801, 1922), ("Архангельская губерния", 1708, 1929), ("Вологодская губерния", 1796, 1929),
    ("Эстляндская губерния", 1721, 1917), ("Лифляндская губерния", 1721, 1917), ("Курляндская губерния", 1795, 1917),
    ("Тверская губерния", 1796, 1929), ("Ярославская губерния", 1796, 1929), ("Костромская губерния", 1796, 1929),
    ("Московская губерния", 1708, 1929), ("Владимирская губерния", 1796, 1929), ("Нижегородская губерния", 1796, 1929),
    ("Казанская губерния", 1708, 1920), ("Симбирская губерния", 1796, 1924), ("Саратовская губерния", 1796, 1928),
    ("Самарская губерния", 1851, 1928), ("Астраханская губерния", 1717, 1928), ("Вятская губерния", 1796, 1929),
    ("Пермская губерния", 1796, 1923), ("Уфимская губерния", 1865, 1922), ("Оренбургская губерния", 1744, 1928),
    ("Смоленская губерния", 1796, 1929), ("Калужская губерния", 1796, 1929), ("Тульская губерния", 1796, 1929),
    ("Рязанская губерния", 1796, 1929), ("Орловская губерния", 1796, 1928), ("Курская губерния", 1796, 1928),
    ("Воронежская губерния", 1725, 1928), ("Тамбовская губерния", 1796, 1928), ("Пензенская губерния", 1796, 1928),
    ("Витебская губерния", 1802, 1924), ("Могилёвская губерния", 1772, 1924), ("Минская губерния", 1793, 1924),
    ("Гродненская губерния", 1795, 1915), ("Виленская губерния", 1795, 1915), ("Ковенская губерния", 1843, 1915),
    ("Киевская губерния", 1708, 1925), ("Волынская губерния", 1795, 1925), ("Подольская губерния", 1793, 1925),
    ("Черниговская губерния", 1802, 1925), ("Полтавская губерния", 1802, 1925), ("Харьковская губерния", 1835, 1925),
    ("Херсонская губерния", 1803, 1925), ("Екатеринославская губерния", 1802, 1925), ("Таврическая губерния", 1802, 1921),
    ("Область Войска Донского", 1786, 1920), ("Ставропольская губерния", 1847, 1924), ("Варшавская губерния", 1867, 1917),
    ("Калишская губерния", 1867, 1917), ("Келецкая губерния", 1867, 1917), ("Ломжинская губерния", 1867, 1917),
    ("Люблинская губерния", 1867, 1917), ("Петроковская губерния", 1867, 1917), ("Плоцкая губерния", 1867, 1917),
    ("Радомская губерния", 1867, 1917), ("Седлецкая губерния", 1867, 1912), ("Сувалкская губерния", 1867, 1917),
)
# Districts of the four provinces; they have their province's years.
DISTRICTS = {
    "Калужская": (
        "Боровский", "Жиздринский", "Калужский", "Козельский", "Лихвинский", "Малоярославецкий", "Медынский", "Мещовский",
        "Мосальский", "Перемышльский", "Тарусский",
    ),
    "Пермская": (
        "Верхотурский", "Екатеринбургский", "Ирбитский", "Камышловский", "Красноуфимский", "Кунгурский", "Осинский",
        "Оханский", "Пермский", "Соликамский", "Чердынский", "Шадринский",
    ),
    "Смоленская": (
        "Бельский", "Вяземский", "Гжатский", "Дорогобужский", "Духовщинский", "Ельнинский", "Краснинский", "Поречский",
        "Рославльский", "Смоленский", "Сычёвский", "Юхновский",
    ),
    "Ярославская": (
        "Даниловский", "Любимский", "Мологский", "Мышкинский", "Переславский", "Пошехонский", "Романово-Борисоглебский",
        "Ростовский", "Рыбинский", "Угличский", "Ярославский",
    ),
}


def unit_rows() -> list[tuple[str, str, str, int, int]]:
    years = {n.split()[0]: (a, b) for n, a, b in PROVINCES}
    out = []
    for province, districts in DISTRICTS.items():
        out.append((province, province, "Губерния", *years[province]))
        out += [(f"{d} уезд", province, "Уезд", *years[province]) for d in districts]
    return out


def units(spark: SparkSession) -> DataFrame:
    """The four provinces and their districts."""
    return inline(spark, unit_rows(), "name string, province string, kind string, year_from int, year_to int")


def provinces(spark: SparkSession) -> DataFrame:
    return inline(spark, list(PROVINCES), "name string, year_from int, year_to int")


def missing_provinces(existing: DataFrame) -> DataFrame:
    """Provinces whose name the table does not have, as its rows; those of the four say so."""
    new = provinces(existing.sparkSession).join(existing.select("name").distinct(), "name", "left_anti")
    return new.select("name", D.province_in(F.col("name")).alias("province"), F.lit("Губерния").alias("kind"), "year_from", "year_to")


def in_force(records: DataFrame, units: DataFrame) -> DataFrame:
    """Records with the units that their title names while those existed; the units are a dimension."""
    named = F.contains("title", F.col("unit")) & (F.col("year_from") <= F.col("to")) & (F.col("year_to") >= F.col("since"))
    small = units.select(F.col("name").alias("unit"), F.col("year_from").alias("since"), F.col("year_to").alias("to"))
    return records.join(F.broadcast(small), named).drop("since", "to")
