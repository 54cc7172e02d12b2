"""Small inline tables, given alike to Spark and to SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.search import inline

TITLES = {
    1: "План 1765-1842",
    2: "[1785]",
    3: "x1765y 1800",
    4: "Карта Смоленскойгубернии1907 г.",
    5: "1700 1701,1999 2039 12345 _1800 1800_",
    6: "Атлас Калужского наместничества",
    7: "Справочник по Иркутской губернии",
    8: "Холмская губерния",
    9: "КартаРоссии1907Года",
    10: "Квартирнаякарта  Пермскойгубернии",
    11: "Список селений Ярославского уезда",
    12: "Волостные правления",
    13: "Karte von Russland",
    14: "Carte de la Russie",
    15: "Tabula Russiae",
    16: "",
    17: "Топографическая карта Пермского уезда, 1796",
    18: "ПЕРЕПИСЬ населения 1897 года, Смоленск",
}
CIPHERS = {1: "Ф.Р-79 Оп.1 т.2 Д.2162", 2: "Ф. 1829 Оп. 1 Д. 15а", 3: "Ф.12 оп.3 Д.4", 4: "без шифра", 5: ""}
SHELVES = {1: "KGR Ko 102/IX-114", 2: "", 3: "ABC", 4: "кгр 17"}
SCALES = {1: "84 000", 2: "1:420 000", 3: "", 4: "без масштаба"}
CODES = {1: "ger", 2: "xyz", 3: "RUSlat", 4: "", 5: "fre"}
FAULTS = {1: "HTTP 403 Forbidden", 2: "Read Timeout 503", 3: "SSL error", 4: "empty page", 5: "odd", 6: "429"}
PERIODS = {1: "1750–1850", 2: "до 1917", 3: "1800", 4: "XVIII в.", 5: "XX в.", 6: "когда-то", 7: "XVII в."}
ACCESSES = {1: "Свободный доступ", 2: "Только читальный зал", 3: "Ограниченный", 4: "", 5: "В открытом  доступе"}
RECORDS = {1: "Название: Карта\nАвтор: Иванов: младший\nГод: 1800", 2: "нет пар", 3: "Шифр: 1\nШифр: 2"}
LINKS = {1: "/item/5#top", 2: "http://x.org/a/?q=1", 3: "#", 4: "mailto:a@b.c", 5: "", 6: "/doc/12345678/"}
MORE_CIPHERS = {
    11: "Ф.Р-79 Оп.1 Д.2162 Планы уезда ГБУ Архив области",
    12: "РГИА Ф. 1350 Оп. 312 (кн. 5) Д. 48",
    13: "дело 1829 1 455 План",
    14: "ЦГА 1234 / 5 / 67",
    15: "Ф.12-а оп. 3 Д. 4",
    16: "МКУ  Городской архив",
}
ROWS = {1: "База данных содержит сведения о картах и планах", 2: "Карта", 3: "Карта Пермской губернии с показанием уездов", 4: "ОТДЕЛ: краеведения и картографии, зал третий"}
PORTALS = {1: "ЭтоМесто: старые карты", 2: "Retromap", 3: "Архив", 4: ""}
WRITTEN = {1: "Калужская", 2: " пермская", 3: "Смоленск", 4: "Тверская", 5: "яросла", 6: "Калужская губерния", 7: "а"}
NAMES = {1: "Калужская губерния", 2: "Пермская и Смоленская", 3: "калужская", 4: ""}
CARDS = {
    1: "Иванов И.И. Карта\nШифр хранения\nKGR Ko 1\nТема\nГеография России и губерний\nРубрики: Карты\nАннотация: показаны уезды и волости",
    2: "план\nПетров А.\nТема\nкоротко\nАннотация: мало",
    3: "Свердловская обл. б-ка; зал; Инв. номер 12",
    4: "",
}
BLOCKS = {1: "a\n\n\nb\n\n\n\n \n\n\nc", 2: "x\n1\nодин\n 23 \nдва\n\n45\nтри", 3: "12345\nнет", 4: "", 5: "7\nсемь"}
SIGNS = {1: "[Карта]", 2: "[[План] уезда", 3: "Год::", 4: ":", 5: "a b*c~d/e+f?", 6: "Калуга & Пермь"}
FORMS = {
    1: "<input type=hidden name='base' value='a'><INPUT TYPE=\"hidden\" NAME=\"base\" VALUE=\"b\"><input type='hidden' name='n'>",
    2: "<input type='text' name='base' value='c'>",
    3: "",
}
HITS = {1: "Найденных документов по запросу: 41", 2: "Количество записей 20", 3: "Результаты поиска: 1-20 из 106", 4: "НАЙДЕНО: 0", 5: "страница 1 из 7", 6: "ничего"}


def spark_table(spark: SparkSession, rows: dict[int, str]) -> DataFrame:
    return inline(spark, list(rows.items()), "id long, t string")


def literal(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_table(rows: dict[int, str]) -> str:
    return "(VALUES " + ", ".join(f"({k}::BIGINT, {literal(v)})" for k, v in rows.items()) + ") v(id, t)"
