"""Values that define the roster domain.

Every constant in this module is a fixed value: results depend on it being exactly this.
"""

# Approved departments, in the order the id cycle uses.
DEPARTMENTS = ("HR", "Engineering", "Finance", "Sales", "Marketing")

# Inclusive contract bounds.
SALARY_MIN = 15000.0
SALARY_MAX = 300000.0
SCORE_MIN = 1
SCORE_MAX = 5

# Pay rules.
MONTHS_PER_YEAR = 12
BONUS_RATE = 0.10
TAX_RATE = 0.08

# Imputation and high-performer rules.
HIGH_SCORE = 4
SCORE_DEFAULT = 3
DATE_DEFAULT = "2024-01-01"
DAYS_PER_YEAR = 365.25
AS_OF_DEFAULT = "2026-07-09"

# Payload derivations.
DESIGNATION_DEFAULT = "Associate"
DESIGNATION_MIN_LENGTH = 3
PAYLOAD_SALARY_BASE = 40000.0
PAYLOAD_SALARY_STEP = 10000.0
PAYLOAD_YEAR = 2024
PAYLOAD_KEY_OFFSET = 2000

# The patterns an address and a date text must match.
EMAIL_PATTERN = r"^[\w\.-]+@[\w\.-]+\.\w+$"
DATE_SHAPE_PATTERN = r"^\d{4}-\d{2}-\d{2}$"

# Header of the roster file.
ROSTER_HEADER = (
    "EmployeeID",
    "Name",
    "Department",
    "Designation",
    "Salary",
    "JoiningDate",
    "PerformanceScore",
)

# The feeds and the data each one falls back to. The time feed also carries the
# epoch second at which it was resolved.
FEED_NAMES = ("Weather", "Holidays", "Time")
FEED_DEFAULTS = {
    "Weather": {"temperature": 28.5, "condition": "Sunny", "location": "Bangalore Office"},
    "Holidays": {"upcoming_holidays_count": 3, "next_holiday": "Republic Day"},
    "Time": {"timezone": "Asia/Kolkata", "dst": False},
}

# Fixed values: (KPI column, metric label, text before the value, text after it, description).
KPI_REPORT_ROWS = (
    ("Headcount", "Total Headcount", "", "", "Active employees across all stores"),
    ("TotalSalaryExpense", "Total Monthly Salary Bill", "₹", "", "Monthly base payroll budget"),
    ("AverageSalary", "Average Monthly Salary", "₹", "", "Mean employee monthly payout"),
    ("MedianSalary", "Median Monthly Salary", "₹", "", "Mid-point salary standard"),
    ("MaxSalary", "Highest Monthly Salary", "₹", "", "Top earner ceiling"),
    ("MinSalary", "Lowest Monthly Salary", "₹", "", "Floor level entry salary"),
    ("AverageTenureYears", "Average Tenure (Years)", "", " years", "Mean employee retention length"),
    ("AveragePerformanceScore", "Average Performance Score", "", " / 5.0", "Overall organizational rating"),
    ("HighPerformersCount", "High Performers Count", "", "", "Rating score of 4 or 5"),
    ("HighPerformersRatio", "High Performers Ratio", "", "%", "Percentage of outstanding staff"),
)

# The five users an unreachable payload source falls back to.
DEFAULT_USERS = [
    {
        "id": 1, "name": "Leanne Graham", "username": "Bret", "email": "Sincere@april.biz",
        "address": {
            "street": "Kulas Light", "suite": "Apt. 556", "city": "Gwenborough",
            "zipcode": "92998-3874", "geo": {"lat": "-37.3159", "lng": "81.1496"},
        },
        "phone": "1-770-736-8031 x56442", "website": "hildegard.org",
        "company": {
            "name": "Romaguera-Crona",
            "catchPhrase": "Multi-layered client-server neural-net",
            "bs": "harness real-time e-markets",
        },
    },
    {
        "id": 2, "name": "Ervin Howell", "username": "Antonette", "email": "Shanna@melissa.tv",
        "address": {
            "street": "Victor Plains", "suite": "Suite 879", "city": "Wisokyburgh",
            "zipcode": "90566-7771", "geo": {"lat": "-43.9509", "lng": "-34.4618"},
        },
        "phone": "010-692-6593 x09125", "website": "anastasia.net",
        "company": {
            "name": "Deckow-Crist",
            "catchPhrase": "Proactive didactic contingency",
            "bs": "synergize scalable supply-chains",
        },
    },
    {
        "id": 3, "name": "Clementine Bauch", "username": "Samantha", "email": "Nathan@yesenia.net",
        "address": {
            "street": "Douglas Extension", "suite": "Suite 847", "city": "McKenziehaven",
            "zipcode": "59590-4157", "geo": {"lat": "-68.6102", "lng": "-47.0653"},
        },
        "phone": "1-463-123-4447", "website": "ramiro.info",
        "company": {
            "name": "Romaguera-Jacobson",
            "catchPhrase": "Face to face bifurcated interface",
            "bs": "e-enable strategic applications",
        },
    },
    {
        "id": 4, "name": "Patricia Lebsack", "username": "Karianne", "email": "Julianne.OConner@kory.org",
        "address": {
            "street": "Hoeger Mall", "suite": "Apt. 692", "city": "South Elvis",
            "zipcode": "53919-4257", "geo": {"lat": "29.4572", "lng": "-164.2990"},
        },
        "phone": "493-170-9623 x156", "website": "kale.biz",
        "company": {
            "name": "Robel-Corkery",
            "catchPhrase": "Multi-tiered zero tolerance productivity",
            "bs": "transition cutting-edge web services",
        },
    },
    {
        "id": 5, "name": "Chelsey Dietrich", "username": "Kamren", "email": "Lucio_Hettinger@annie.ca",
        "address": {
            "street": "Skiles Walks", "suite": "Suite 351", "city": "Roscoeview",
            "zipcode": "33263", "geo": {"lat": "-31.8129", "lng": "62.5342"},
        },
        "phone": "(254)954-1289", "website": "demarco.info",
        "company": {
            "name": "Keebler LLC",
            "catchPhrase": "User-centric fault-tolerant solution",
            "bs": "revolutionize end-to-end systems",
        },
    },
]
