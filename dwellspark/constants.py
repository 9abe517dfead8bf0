"""Words, tokens and limits that the results depend on."""

# They have to equal the ones the report data was produced for.

WHITESPACE = " \t\n\r\x0b\x0c\u00a0"

EMPTY_STAGE = ("", "-", "nan", "none")
EMPTY_SNAPSHOT = ("", "-", "nan", "none", "null", "nat")
EMPTY_NAME = ("", "-", "—", "nan", "none", "null")
EMPTY_ID = ("", "-", "—", "nan", "none", "null", "nat")
EMPTY_TEXT_ID = ("", "-", "—", "nan", "none", "null", "nat", "<na>")
EMPTY_DATE = ("", "-", "nan", "none", "nat", "null", "n/a")
EMPTY_MANAGER = ("", "-", "nan", "none")
NULL_WORDS = ("nan", "None", "NaT", "<NA>")

LEADER_WORDS = ("да", "yes", "true", "1")
TEAM_LEAD_TYPES = ("1",)
TEAM_DEAL_TYPES = ("2",)

DATE_PATTERNS = (
    "d.M.yyyy", "d.M.yy", "yyyy-M-d", "d/M/yyyy", "M/d/yyyy", "d-M-yyyy", "yyyy.M.d", "yyyy/M/d", "yyyyMMdd",
    "d MMM yyyy", "d MMMM yyyy", "MMM d, yyyy", "MMMM d, yyyy",
)
SERIAL_DATE_ORIGIN = "1899-12-30"
# Day serials outside this range are no dates (up to the end of 2199).
SERIAL_DATE_RANGE = (1, 109_574)

TAB_NUMBER_WIDTH = 8
CONTROL_CHARS = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x{d800}-\x{dfff}\x{feff}\x{fffe}\x{ffff}]"

ALL_TERRITORIES = "все тб"
ALL_SERIES = "__ALL__"
GROUP_ONLY_PRODUCT = "—"
EXCEEDED_FLAG = "ДА"

ROLE_KM = "КМ"
ROLE_VKS = "ВКС"
ROLE_KM_SUMMARY = "ВКО"
ROLE_LEAD_LEADER = "Лидер лида"
ROLE_DEAL_LEADER = "Лидер сделки"
LEAD_TEAM_PREFIX = "Команда лида · "
DEAL_TEAM_PREFIX = "Команда сделки · "
TEAM_DEFAULT_ROLE = "лидер"

LABEL_STRATEGY = "Стратегия"
LABEL_YEAR = "2026"

STATUS_ORDER = (
    "К продаже",
    "Выявление потребности",
    "Обсуждение условий",
    "Реализация сделки",
    "Активация продукта",
    "Продажа завершена",
)

LEGAL_FORMS = (
    ("публичное акционерное общество", "ПАО"),
    ("непубличное акционерное общество", "НАО"),
    ("закрытое акционерное общество", "ЗАО"),
    ("открытое акционерное общество", "ОАО"),
    ("общество с ограниченной ответственностью", "ООО"),
    ("акционерное общество", "АО"),
    ("индивидуальный предприниматель", "ИП"),
    ("федеральное государственное бюджетное учреждение", "ФГБУ"),
    ("федеральное государственное унитарное предприятие", "ФГУП"),
    ("государственное унитарное предприятие", "ГУП"),
    ("муниципальное унитарное предприятие", "МУП"),
    ("автономная некоммерческая организация", "АНО"),
    ("некоммерческая организация", "НКО"),
    ("товарищество собственников жилья", "ТСЖ"),
    ("товарищество собственников недвижимости", "ТСН"),
    ("крестьянское (фермерское) хозяйство", "КФХ"),
    ("крестьянское фермерское хозяйство", "КФХ"),
    ("производственный кооператив", "ПК"),
    ("сельскохозяйственный производственный кооператив", "СПК"),
    ("полное товарищество", "ПТ"),
    ("товарищество на вере", "ТНВ"),
    ("коммандитное товарищество", "КТ"),
)
