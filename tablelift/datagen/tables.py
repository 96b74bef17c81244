"""The eight test tables. Each takes a frame of row ids (``id`` bigint, from 1)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tablelift.datagen.draws import Draws, anchor, scaled, zero_padded

ROWS_PER_PARTITION = 1_000_000
LEAST_ROWS_PER_PARTITION = 25_000
DAY = 86_400

# Full-size row counts and the values the test tables draw from.
TABLE_ROWS = {
    "dbo.customers": 500_000,
    "dbo.products": 100_000,
    "dbo.orders": 2_000_000,
    "dbo.order_items": 10_000_000,
    "dbo.events": 10_000_000,
    "dbo.measurements": 5_000_000,
    "sales.transactions": 2_000_000,
    "hr.employees": 50_000,
}
FIRST_NAMES = (
    "James", "Mary", "John", "Patricia", "Robert", "Jennifer", "Michael", "Linda", "William",
    "Barbara", "David", "Elizabeth", "Richard", "Susan", "Joseph", "Jessica", "Thomas", "Sarah",
    "Charles", "Karen",
)
LAST_NAMES = (
    "Smith", "Johnson", "Williams", "Brown", "Jones", "Garcia", "Miller", "Davis", "Rodriguez",
    "Martinez", "Hernandez", "Wilson", "Anderson", "Taylor", "Moore", "Jackson", "Martin",
    "Thompson", "White", "Harris",
)
MIDDLE_NAMES = ("Lee", "Ann", "Marie", "Ray", "Lynn", "Paul", "Grace", "Jay", "Mae", "Earl")
MAIL_HOSTS = (
    "gmail.com", "yahoo.com", "hotmail.com", "outlook.com", "icloud.com", "protonmail.com",
)
STREETS = (
    "Main St", "Oak Ave", "Maple Dr", "Cedar Ln", "Park Blvd", "Washington Ave", "Lake Rd",
    "Hill St", "River Dr", "Forest Way",
)
CITIES = (
    "New York", "Los Angeles", "Chicago", "Houston", "Phoenix", "Philadelphia", "San Antonio",
    "San Diego", "Dallas", "San Jose", "Austin", "Jacksonville", "Fort Worth", "Columbus",
    "Charlotte", "Indianapolis", "San Francisco", "Seattle", "Denver", "Nashville",
)
STATES = (
    "NY", "CA", "TX", "FL", "IL", "PA", "OH", "GA", "NC", "MI", "WA", "AZ", "CO", "TN", "MA",
    "IN", "MO", "MD", "WI", "MN",
)
CITY_STATES = (
    "New York, NY", "Los Angeles, CA", "Chicago, IL", "Houston, TX", "Phoenix, AZ",
    "Philadelphia, PA", "San Antonio, TX", "San Diego, CA", "Dallas, TX", "Austin, TX",
)
PRODUCT_LINES = (
    "Elite", "Pro", "Ultra", "Slim", "Max", "Eco", "Smart", "Classic", "Turbo", "Prime",
)
CATEGORIES = (
    "Electronics", "Clothing", "Food", "Books", "Sports", "Home", "Garden", "Automotive",
    "Health", "Toys",
)
SUB_CATEGORIES = (
    "Premium", "Budget", "Organic", "Digital", "Wireless", "Manual", "Portable", "Heavy-Duty",
    "Lightweight", "Compact",
)
BRANDS = (
    "Apple", "Samsung", "Nike", "Adidas", "Sony", "LG", "Dell", "HP", "Lenovo", "Philips",
    "Bosch", "Siemens", "Panasonic", "Toshiba", "Sharp",
)
TAGS = ("new,sale", "featured,hot", "clearance", "bestseller,new", "limited-edition")
COLORS = (
    "Red", "Blue", "Green", "Black", "White", "Silver", "Gold", "Gray", "Brown", "Purple",
)
ORDER_STATES = ("PENDING", "PROCESSING", "SHIPPED", "DELIVERED", "CANCELLED")
PAYMENT_METHODS = ("CREDIT_CARD", "DEBIT_CARD", "PAYPAL", "BANK_TRANSFER", "CRYPTO", "CHECK")
PAYMENT_STATES = ("PENDING", "PAID", "FAILED", "REFUNDED")
WAREHOUSES = (
    "WH01", "WH02", "WH03", "WH04", "WH05", "WH06", "WH07", "WH08", "WH09", "WH10",
)
DEPARTMENTS = (
    "Engineering", "Sales", "Marketing", "Finance", "HR", "Operations", "Legal", "Product",
    "Design", "Support",
)
JOB_TITLES = (
    "Software Engineer", "Product Manager", "Sales Executive", "Account Manager",
    "Data Analyst", "DevOps Engineer", "UX Designer", "Financial Analyst", "HR Specialist",
    "Operations Manager",
)
OFFICES = (
    "New York HQ", "San Francisco", "Austin TX", "Chicago", "Seattle", "Boston", "Atlanta",
    "Remote",
)
TIME_ZONES = (
    "America/New_York", "America/Chicago", "America/Denver", "America/Los_Angeles",
    "America/Phoenix", "UTC",
)
TRANSACTION_TYPES = ("DEBIT ", "CREDIT", "XFER  ", "FEE   ", "REFUND")
CURRENCIES = ("USD", "EUR", "GBP", "JPY", "CAD")
MERCHANTS = (
    "Amazon", "Walmart", "Target", "Best Buy", "Starbucks", "McDonald's", "Netflix", "Spotify",
    "Apple Store", "Google Play", "Uber", "Lyft", "DoorDash", "Instacart", "Airbnb",
)
MERCHANT_CODES = (
    "5411", "5812", "5912", "7011", "5661", "4111", "5311", "5999", "7832", "5621",
)
TRANSACTION_TEXTS = (
    "Online purchase", "In-store payment", "Subscription renewal", "Wire transfer",
    "ATM withdrawal", "Refund processing",
)
TRANSACTION_STATES = ("POSTED", "PENDING", "CLEARED", "REVERSED")
CHANNELS = ("web", "mobile", "branch", "api")
EVENT_TYPES = (
    "USER_LOGIN", "USER_LOGOUT", "PAGE_VIEW", "PURCHASE", "API_CALL", "ERROR", "WARNING",
    "AUDIT", "ALERT", "DATA_EXPORT",
)
EVENT_SOURCES = (
    "web-app", "mobile-ios", "mobile-android", "api-gateway", "admin-portal", "batch-job",
    "webhook", "scheduler",
)
USER_AGENTS = (
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 Chrome/120.0.0.0",
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_7) AppleWebKit/537.36 Safari/537.36",
    "Mozilla/5.0 (iPhone; CPU iPhone OS 17_0 like Mac OS X) Mobile/15E148",
)
ERROR_TEXTS = (
    "Connection timeout", "Authentication failed", "Resource not found", "Rate limit exceeded",
    "Internal server error",
)
DEVICE_TYPES = (
    "temperature-sensor", "pressure-sensor", "flow-meter", "current-sensor",
    "vibration-sensor", "humidity-sensor", "power-meter", "environmental",
)


def row_ids(spark: SparkSession, rows: int) -> DataFrame:
    fewest = math.ceil(rows / ROWS_PER_PARTITION)
    cores = spark.sparkContext.defaultParallelism
    parts = max(1, fewest, min(cores, math.ceil(rows / LEAST_ROWS_PER_PARTITION)))
    return spark.range(1, rows + 1, numPartitions=parts)


def _table(ids: DataFrame, **columns: Column) -> DataFrame:
    return ids.select(*[column.alias(name) for name, column in columns.items()])


def _phone(d: Draws, name: str) -> Column:
    return F.concat(F.lit("+1"), d.digits(name, 200_000_000, 999_999_999, 10))


def _text(value: str | None = None) -> Column:
    return F.lit(value).cast("string")


def customers(ids: DataFrame, seed: int = 1) -> DataFrame:
    row = F.col("id")
    d = Draws(row, seed)
    last_name = d.pick("last_name", LAST_NAMES)
    first_name = d.pick("first_name", FIRST_NAMES)
    return _table(
        ids,
        customer_id=row.cast("int"),
        guid_id=d.uuid("guid"),
        first_name=first_name,
        last_name=last_name,
        email=F.concat(
            F.lower(F.substring(first_name, 1, 1)),
            F.lower(last_name),
            row.cast("string"),
            F.lit("@"),
            d.pick("mail_host", MAIL_HOSTS),
        ),
        phone=_phone(d, "phone"),
        birth_date=d.days_ago("birth_date", 7_305, 27_393),
        gender=d.maybe("gender", 80, d.pick("gender", ("M", "F"))),
        address_line1=F.concat_ws(" ", d.between("house", 1, 9_999), d.pick("street", STREETS)),
        address_line2=_text(),
        city=d.pick("city", CITIES),
        state_province=d.pick("state", STATES),
        country_code=_text("US"),
        postal_code=d.digits("postal_code", 0, 99_998, 5),
        is_active=d.chance("is_active", 90),
        credit_limit=d.between("credit_limit", 500, 50_000).cast("decimal(18,2)"),
        loyalty_points=d.between("loyalty_points", 0, 200_000),
        account_balance=d.hundredths("balance", -100_000, 4_999_999, "decimal(19,4)"),
        registration_dt=d.seconds_ago("registration", 5 * 365 * DAY),
        last_login=d.maybe("last_login", 80, d.seconds_ago("last_login", 90 * DAY)),
        notes=d.maybe("notes", 20, F.concat(F.lit("Customer notes: "), d.uuid("notes"))),
        created_at=anchor(),
        updated_at=anchor(),
    )


def products(ids: DataFrame, seed: int = 2) -> DataFrame:
    row = F.col("id")
    d = Draws(row, seed)
    sku = F.concat(F.lit("SKU-"), zero_padded(row, 6))
    category = d.pick("category", CATEGORIES)
    side = [d.between(f"side_{i}", 10, 100).cast("string") for i in range(3)]
    specifications = F.to_json(
        F.struct(
            d.between("weight_g", 100, 10_000).alias("weight_g"),
            F.concat(F.concat_ws("x", *side), F.lit("cm")).alias("dims"),
            d.pick("color", COLORS).alias("color"),
            d.between("warranty", 12, 36).alias("warranty_months"),
        )
    )
    return _table(
        ids,
        product_id=row.cast("int"),
        sku=sku,
        product_name=F.concat(
            F.concat_ws(" ", d.pick("line", PRODUCT_LINES), category),
            F.lit(" #"),
            row.cast("string"),
        ),
        description=F.concat(
            F.lit("High-quality product in the "),
            category,
            F.lit(" category. "),
            sku,
            F.lit(". Manufactured to highest standards."),
        ),
        category=category,
        sub_category=d.maybe("sub_category", 80, d.pick("sub_category", SUB_CATEGORIES)),
        brand=d.pick("brand", BRANDS),
        unit_price=d.hundredths("unit_price", 100, 99_999, "decimal(19,4)"),
        cost_price=d.hundredths("cost_price", 50, 40_049, "decimal(10,4)"),
        weight_kg=d.hundredths("weight_kg", 10, 5_000, "float"),
        stock_qty=d.between("stock_qty", 0, 10_000).cast("int"),
        reorder_level=d.between("reorder_level", 5, 100).cast("int"),
        is_available=d.chance("is_available", 95),
        rating=d.maybe("rating", 80, d.hundredths("rating", 100, 500, "decimal(3,2)")),
        review_count=d.between("review_count", 0, 5_000).cast("int"),
        image_url=_text(),
        tags=d.pick("tags", TAGS),
        specifications=specifications,
        created_at=anchor(),
    )


def orders(ids: DataFrame, seed: int = 3, customer_rows: int = 500_000) -> DataFrame:
    row = F.col("id")
    d = Draws(row, seed)
    order_date = d.seconds_ago("order_date", 3 * 365 * DAY)
    shipped = F.timestamp_add("DAY", d.between("ship_days", 2, 7).cast("int"), order_date)
    address = F.concat(
        F.concat_ws(" ", d.between("house", 1, 999), d.pick("street", STREETS[:8])),
        F.lit(", "),
        F.concat_ws(" ", d.pick("city", CITY_STATES), d.digits("zip", 0, 99_998, 5)),
    )
    return _table(
        ids,
        order_id=row.cast("int"),
        order_number=F.concat(F.lit("ORD-"), zero_padded(row, 7)),
        customer_id=d.between("customer", 1, customer_rows).cast("int"),
        status=d.pick("status", ORDER_STATES),
        order_date=order_date,
        required_date=F.date_add(order_date.cast("date"), d.between("due", 3, 14).cast("int")),
        shipped_date=d.maybe("shipped", 70, shipped),
        total_amount=d.hundredths("total", 1_000, 499_999, "decimal(19,4)"),
        tax_amount=d.hundredths("tax", 0, 5_999, "decimal(19,4)"),
        discount_amount=d.hundredths("discount", 0, 20_000, "decimal(19,4)"),
        shipping_cost=d.hundredths("shipping", 0, 9_998, "decimal(10,4)"),
        payment_method=d.pick("payment_method", PAYMENT_METHODS),
        payment_status=d.pick("payment_status", PAYMENT_STATES),
        shipping_addr=address,
        tracking_number=d.maybe(
            "tracking", 70, F.concat(F.lit("1Z"), zero_padded(d.number("tracking"), 14))
        ),
        notes=d.maybe(
            "notes", 10, F.concat(F.lit("Special handling required. Ref: "), d.uuid("notes"))
        ),
        created_at=anchor(),
    )


def order_items(
    ids: DataFrame, seed: int = 4, order_rows: int = 2_000_000, product_rows: int = 100_000
) -> DataFrame:
    row = F.col("id")
    d = Draws(row, seed)
    return _table(
        ids,
        item_id=row,
        order_id=d.between("order", 1, order_rows).cast("int"),
        product_id=d.between("product", 1, product_rows).cast("int"),
        quantity=d.between("quantity", 1, 20).cast("smallint"),
        unit_price=d.hundredths("unit_price", 100, 99_999, "decimal(19,4)"),
        discount_pct=d.hundredths("discount", 0, 3_000, "decimal(5,2)"),
        line_total=d.hundredths("line_total", 100, 999_999, "decimal(19,4)"),
        warehouse_code=d.pick("warehouse", WAREHOUSES),
        notes=_text(),
    )


def employees(ids: DataFrame, seed: int = 5) -> DataFrame:
    row = F.col("id")
    d = Draws(row, seed)
    code = zero_padded(row, 5)
    alphabet = F.lit("abcdefghijklmnopqrstuvwxyz")
    initial = F.substr(alphabet, (row % 26 + 1).cast("int"), F.lit(1))
    bio = F.concat(
        F.lit("Experienced professional with "),
        d.between("years", 1, 20).cast("string"),
        F.lit(" years in the industry."),
    )
    return _table(
        ids,
        emp_id=row.cast("int"),
        emp_code=F.concat(F.lit("EMP-"), code),
        first_name=d.pick("first_name", FIRST_NAMES),
        last_name=d.pick("last_name", LAST_NAMES),
        middle_name=d.maybe("middle_name", 40, d.pick("middle_name", MIDDLE_NAMES)),
        email=F.concat(initial, code, F.lit("@corp.example.com")),
        phone_work=_phone(d, "phone_work"),
        phone_mobile=d.maybe("phone_mobile", 80, _phone(d, "phone_mobile")),
        department=d.pick("department", DEPARTMENTS),
        job_title=d.pick("job_title", JOB_TITLES),
        job_level=d.between("job_level", 1, 8).cast("smallint"),
        manager_id=F.when(row > 100, d.between("manager", 101, 5_000).cast("int")),
        hire_date=d.days_ago("hire_date", 0, 7_304),
        termination_dt=d.maybe("termination", 5, d.days_ago("termination", 0, 1_824)),
        salary=d.between("salary", 30_000, 250_000).cast("decimal(19,4)"),
        bonus_pct=d.hundredths("bonus", 0, 3_000, "decimal(5,2)"),
        is_full_time=d.chance("is_full_time", 90),
        office_location=d.pick("office", OFFICES),
        country_code=_text("US"),
        timezone=d.pick("timezone", TIME_ZONES),
        bio=d.maybe("bio", 25, bio),
        created_at=anchor(),
    )


def transactions(ids: DataFrame, seed: int = 6) -> DataFrame:
    row = F.col("id")
    d = Draws(row, seed)
    batch_day = F.date_format(d.days_ago("batch_day", 0, 364), "yyyyMMdd")
    metadata = F.to_json(
        F.struct(
            d.pick("channel", CHANNELS).alias("channel"), d.uuid("device").alias("device_id")
        )
    )
    return _table(
        ids,
        trans_id=row,
        trans_uuid=d.uuid("uuid"),
        account_number=F.concat(*[d.digits(f"account_{i}", 0, 9_999, 4) for i in range(4)]),
        trans_type=d.pick("type", TRANSACTION_TYPES),
        amount=d.hundredths("amount", 1, 999_999, "decimal(18,4)"),
        currency=d.pick("currency", CURRENCIES),
        exchange_rate=scaled(d.between("rate", 800_000, 1_000_000), 6, "decimal(10,6)"),
        amount_usd=d.hundredths("amount_usd", 1, 999_999, "decimal(18,4)"),
        trans_datetime=d.seconds_ago("trans_datetime", 2 * 365 * DAY),
        value_date=d.days_ago("value_date", 0, 729),
        reference_num=d.maybe(
            "reference", 30, F.concat(F.lit("REF"), zero_padded(d.number("reference"), 12))
        ),
        merchant_name=d.pick("merchant", MERCHANTS),
        merchant_cat=d.pick("merchant_code", MERCHANT_CODES),
        description=d.pick("description", TRANSACTION_TEXTS),
        status=d.pick("status", TRANSACTION_STATES),
        is_reversed=d.chance("is_reversed", 5),
        batch_id=F.concat_ws("-", F.lit("BATCH"), batch_day, d.digits("batch", 0, 9_998, 4)),
        metadata=metadata,
    )


def events(ids: DataFrame, seed: int = 7, customer_rows: int = 500_000) -> DataFrame:
    row = F.col("id")
    d = Draws(row, seed)
    event_time = d.seconds_ago("event_time", 365 * DAY)
    bounds = ((1, 254), (0, 255), (0, 255), (1, 254))
    octets = [d.between(f"octet_{i}", *b).cast("string") for i, b in enumerate(bounds)]
    handled = F.timestamp_add("SECOND", d.between("handling", 0, 3_599).cast("int"), event_time)
    epoch = F.lit("2020-01-01 00:00:00").cast("timestamp_ntz")
    payload = F.to_json(
        F.struct(
            d.uuid("payload").alias("id"),
            F.timestamp_diff("SECOND", epoch, anchor()).alias("ts"),
            d.chance("payload_ok", 90).alias("ok"),
        )
    )
    error_code = F.concat(F.lit("ERR-"), d.between("error_code", 1_000, 9_999).cast("string"))
    return _table(
        ids,
        event_id=row,
        event_uuid=d.uuid("uuid"),
        event_type=d.pick("type", EVENT_TYPES),
        source_system=d.pick("source", EVENT_SOURCES),
        severity=d.between("severity", 0, 4).cast("smallint"),
        event_time=event_time,
        duration_ms=d.maybe("duration", 80, d.between("duration", 1, 29_999).cast("int")),
        user_id=d.maybe("user", 90, d.between("user", 1, customer_rows).cast("int")),
        session_id=d.uuid("session"),
        ip_address=F.concat_ws(".", *octets),
        user_agent=d.maybe("user_agent", 60, d.pick("user_agent", USER_AGENTS)),
        payload=payload,
        error_code=d.maybe("error_code", 20, error_code),
        error_message=d.maybe("error_message", 20, d.pick("error_message", ERROR_TEXTS)),
        is_processed=d.chance("is_processed", 80),
        processed_at=d.maybe("processed_at", 80, handled),
    )


def measurements(ids: DataFrame, seed: int = 8) -> DataFrame:
    row = F.col("id")
    d = Draws(row, seed)

    def degrees(name: str, limit: int) -> Column:
        steps = d.between(name, -limit * 100_000, limit * 100_000 - 1)
        return scaled(steps, 5, "decimal(9,6)")

    return _table(
        ids,
        meas_id=row,
        sensor_id=F.concat_ws(
            "-", F.lit("DEV"), d.digits("sensor", 1, 99_999, 5), d.digits("channel", 0, 98, 2)
        ),
        device_type=d.pick("device_type", DEVICE_TYPES),
        measured_at=d.seconds_ago("measured_at", 180 * DAY),
        temperature_c=d.hundredths("temperature", -4_000, 8_500, "float"),
        pressure_hpa=d.hundredths("pressure", 80_000, 120_000, "double"),
        humidity_pct=d.hundredths("humidity", 0, 10_000, "decimal(5,2)"),
        voltage_v=d.hundredths("voltage", 0, 4_800, "float"),
        current_a=d.hundredths("current", 0, 2_000, "float"),
        power_watts=d.hundredths("power", 0, 100_000, "double"),
        latitude=degrees("latitude", 90),
        longitude=degrees("longitude", 180),
        altitude_m=d.hundredths("altitude", -10_000, 879_000, "float"),
        signal_strength=d.between("signal", -120, 0).cast("smallint"),
        battery_pct=d.between("battery", 0, 100).cast("smallint"),
        raw_bytes=F.unhex(F.concat(d.digest("raw_1"), d.digest("raw_2"))),
        checksum=F.unhex(d.digest("checksum")),
    )


GENERATORS = {
    "dbo.customers": customers,
    "dbo.products": products,
    "dbo.orders": orders,
    "dbo.order_items": order_items,
    "dbo.events": events,
    "dbo.measurements": measurements,
    "sales.transactions": transactions,
    "hr.employees": employees,
}


def generate(spark: SparkSession, name: str, scale: float = 1.0) -> DataFrame:
    """A test table at its full row count times ``scale``."""
    return GENERATORS[name](row_ids(spark, max(1, round(TABLE_ROWS[name] * scale))))
