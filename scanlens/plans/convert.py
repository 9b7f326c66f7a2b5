"""Scan reports to a flow file.

python -m scanlens.plans.convert --scans-dir scans/ --output features/
"""

from __future__ import annotations

import argparse

from scanlens import constants as K
from scanlens.plans.replay import scans_to_csv
from scanlens.session import build_session


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Turn scan reports into feature rows")
    parser.add_argument("--scans-dir", required=True)
    parser.add_argument("--output", default="scan_features")
    parser.add_argument("--src-ip", default=K.DEFAULT_SOURCE_IP, help="source address of the rows")
    options = parser.parse_args(arguments)
    spark = build_session("scanlens-convert")
    rows = scans_to_csv(spark, options.scans_dir, options.output, options.src_ip)
    print(f"{rows.count()} feature rows written to {options.output}")


if __name__ == "__main__":
    main()
