"""`python -m waybill --raw DIR --out DIR`, or the same arguments after spark-submit."""

from __future__ import annotations

import argparse

from waybill.params import Params
from waybill.plans.job import run_pipeline
from waybill.session import get_session


def main() -> None:
    defaults = Params()
    parser = argparse.ArgumentParser(prog="waybill")
    parser.add_argument("--raw", required=True, help="folder of the raw CSV inputs")
    parser.add_argument("--out", required=True, help="folder for tables, extracts and reports")
    parser.add_argument("--window", type=int, default=defaults.window_days)
    parser.add_argument("--min-seller-orders", type=int, default=defaults.min_seller_orders)
    given = parser.parse_args()
    params = Params(window_days=given.window, min_seller_orders=given.min_seller_orders)
    run_pipeline(get_session(), given.raw, given.out, params)


if __name__ == "__main__":
    main()
