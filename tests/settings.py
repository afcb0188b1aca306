import os

SMALL_DIR = os.environ.get("DAYBOOK_SMALL_DIR", "/root/testdata/sf0.001")
SQL_DIR = os.environ.get("DAYBOOK_SQL_DIR", SMALL_DIR)
