"""Vocabularies and dimensions that results depend on."""

from __future__ import annotations

# Stems of the document type, the series, the scale, the form, the period and the mining district.
PRIMARY = ("карт", "план", "схем", "атлас", "съёмк", "съемк", "чертёж", "чертеж")
SERIES = (
    "топографическ", "военно-топограф", "семитопограф", "геометрическ", "глазомерн",
    "рекогносц", "генеральн", "межеван", "лесн", "дач",
)
SCALE = ("дюйме", "верст", "вёрст", "масштаб")
FORM = ("рукописн", "рук.", "граверн", "литограф", "печатн")
HISTORICAL = ("наместничеств",)
PERM = ("завод", "горн", "рудник")
POSITIVE = PRIMARY + SERIES + SCALE + FORM + HISTORICAL + PERM
DOUBTFUL = ("статистическ", "перепис", "список сел", "список насел", "наделов", "волост", "справочн", "адрес-календар")
GROUPS = {"primary": PRIMARY, "series": SERIES, "scale": SCALE, "form": FORM, "historical": HISTORICAL, "perm": PERM, "doubtful": DOUBTFUL}
COLLECTION = ("карт", "план", "атлас", "топограф", "съёмк", "геодез", "чертёж", "чертеж", "межев", "географ", "картограф")
RUBRICS = ("карт", "план", "атлас", "к 26", "к о")
SHELFMARKS = ("KGR", "КГР")
STOP_WORDS = ("и", "в", "на", "по", "за", "из", "от", "до", "об", "к", "с", "у", "а", "но", "или", "не", "для", "при", "под")

# The four provinces, then their districts.
PROVINCES = {
    "калужская": ("Калужская губерния", "Калужское наместничество"),
    "пермская": ("Пермская губерния", "Пермское наместничество"),
    "смоленская": ("Смоленская губерния", "Смоленское наместничество"),
    "ярославская": ("Ярославская губерния", "Ярославское наместничество"),
}
DISTRICTS = {
    "калужская": (
        "Калужский уезд", "Мосальск", "Медынь", "Мещовск", "Перемышль", "Козельск", "Лихвин", "Тарусский",
        "Малоярославецкий", "Думиничский", "Карачев", "Болхов",
    ),
    "пермская": ("Пермский уезд", "Оса", "Соликамск", "Чердынь", "Верхотурье", "Орёл", "Кунгур", "Кизел", "Ирбит"),
    "смоленская": (
        "Смоленский уезд", "Ржев", "Вязьма", "Дорогобуж", "Сафоново", "Сычёвка", "Духовщина", "Гжатск", "Красный",
        "Рославль", "Велиж",
    ),
    "ярославская": (
        "Ярославский уезд", "Углич", "Мышкин", "Ростов", "Переславль-Залесский", "Ярославец", "Мологский", "Пошехонье",
        "Мышкинский",
    ),
}
KEYWORDS = ("карта", "план", "атлас", "съёмка", "чертёж", "топографическая")

# Sources of a run in order of priority, and how each is read.
SOURCES = (
    ("gpib", "query"), ("prlib", "query"), ("nlr_cart", "query"), ("neb", "query"),
    ("rsl", "query"), ("permkrai", "query"), ("kaluga_lib", "query"), ("smolensk_lib", "walk"),
)
OTHER_SOURCES = (("yaroslavl_lib", "query"), ("rgo", "query"), ("aonb", "query"))

# Regions by the stem that names them, in order.
REGIONS = (("калуж", "Калужская область"), ("перм", "Пермский край"), ("смолен", "Смоленская область"), ("ярослав", "Ярославская область"))
LANGUAGE_CODES = {"rus": "Русский", "lat": "Латинский", "ger": "Немецкий", "fre": "Французский", "pol": "Польский"}
OTHER_LANGUAGE = "Другой"
GERMAN_WORDS = ("der", "die", "das", "von", "und")
FRENCH_WORDS = ("de", "du", "la", "le", "les", "et")

# What a fault is recognised by, in the order it is looked for.
FAULTS = ("403", "404", "429", "503", "timeout", "connection", "ssl", "empty")
CENTURIES = (("XVIII", 1700), ("XIX", 1800), ("XX", 1900), ("XVII", 1600), ("XVI", 1500))
ACCESS = (("свободный", "free"), ("читальный зал", "reading_room"), ("ограниченный", "limited"))
EMPTY_LIMIT = ERROR_LIMIT = 5
GEO_WORDS = ("губерни", "наместничеств", "уезд", "план города")
NOT_MAPS = ("трудового процесса", "технологическ", "качества", "учёта")
DOCUMENT_TYPES = ("Однотомник", "Многотомник", "Статья", "Дореволюционное", "Аналитика")
TERRITORY_STEMS = ("Калуж", "Перм", "Смолен", "Яросл", "Москов")
PORTAL_SLUGS = (("калужская", "kaluga"), ("пермская", "perm"), ("смоленская", "smolensk"), ("ярославская", "yaroslavl"))
GUBERNIA_SLUGS = (
    ("калужская", "kaluzhskaya-guberniya"), ("пермская", "permskaya-guberniya"), ("смоленская", "smolenskaya-guberniya"),
    ("ярославская", "yaroslavskaya-guberniya"),
)
CATEGORY = "карты, схемы, планы"

# What to try for each kind of fault, and otherwise.
WORKAROUNDS = {
    "403": "Заблокирован по IP или требует авторизацию. Попробовать: VPN (Европа/Россия), изменить User-Agent, авторизоваться вручную и взять cookie.",
    "404": "Страница поиска изменила URL. Проверить актуальный адрес на сайте вручную.",
    "429": "Слишком частые запросы. Увеличить delay в _get() до 5–10 сек, добавить паузы между сессиями.",
    "503": "Сервер временно недоступен. Повторить через несколько часов или дней.",
    "timeout": "Сервер не отвечает в течение 25 сек. Попробовать в другое время суток. Возможно, сайт на техобслуживании.",
    "connection": "Нет сетевого соединения с сервером. Проверить блокировки, попробовать VPN.",
    "ssl": "Проблема с сертификатом SSL. Попробовать requests.get(..., verify=False) с осторожностью.",
    "empty": "Сайт отвечает, но поиск не возвращает результатов. Возможно, изменилась структура страницы — проверить CSS-селекторы вручную.",
    "other": "Проверить сайт вручную и обновить разбор страниц, если изменилась структура.",
}
# Portals, rows that are no records, words of titles that are known to mark maps.
PORTALS = ("руниверс", "retromap", "southklad", "qmap", "этоместо", "etomesto")
NO_RECORDS = ("база данных", "формат", "отдел:")
KNOWN_TRIGGERS = ("план", "карта", "схема", "масштаб", "атлас", "съёмка", "съемка", "чертёж", "чертеж")
# Patterns of whole shelfmarks, by who writes them so.
CIPHER_SHAPES = {
    "gako": r"Ф[.\s][\p{L}\p{N}_.-]+\s+[Оо]п[.\s]\S+\s+Д[.\s]\S+",
    "gako_row": r"Ф\.\s*[\p{L}\p{N}_-]+\s+[Оо]п\.\s*[0-9]+\s+Д\.\s*[0-9]+",
    "rgia": r"Ф\.\s*[0-9-]+\s+Оп\.\s*[0-9-]+[^<\n]*Д\.\s*[0-9-]+",
    "gayao": r"^Ф\.[\p{L}\p{N}_.\s-]+Д\.\s*[\p{L}\p{N}_]+",
    "kaluga": r"Ф\.Р-[0-9]+\s+Оп\.[0-9]+\s+Д\.[0-9]+",
    "cgamos": r"[0-9]{3,}\s*/\s*[0-9]+\s*/\s*[0-9]+",
    "garf": r"1829\s+1\s+[0-9]+",
}
# A whole cipher, and the number of a case by name unless it is marked as a year or begins a period.
CIPHER = r"(?<![\p{L}\p{N}_])Ф[.\s]+[\p{L}\p{N}_.-]+[,;]?\s+[Оо]п[.\s]+\S+\s+(?:т[.\s]+\S+\s+)?[Дд][.\s]+[0-9][\p{L}\p{N}_/-]*"
CASE = r"(?:^\s*Д[.\s]+|(?<![\p{L}\p{N}_])[Дд]ело\s+(?:№\s*)?)[0-9]{4}(?![\p{L}\p{N}_])(?!\s*(?:[-–—]\s*[0-9]{4}|гг?(?![\p{L}\p{N}_])|год))"
ARCHIVE_AT_END = r"(ГБУ|МКУ|ГАУ|ГБУК)\s+[\p{L}\p{N}_\s]+$"
# How pages tell the number of hits, in order of preference.
TOTALS = (r"Найденных документов[^:]*:\s*([0-9]+)", r"Количество\s+записей[:\s]*([0-9]+)", r"Результаты[^:]*:\s*[0-9-]+\s+из\s+([0-9]+)", r"Найдено[:\s]*([0-9]+)", r"из\s+([0-9]+)")
