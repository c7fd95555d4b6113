"""spark-submit entry: ``spark-submit --py-files reeflens.zip run_analysis.py --historic ...``."""

from reeflens.__main__ import main

if __name__ == "__main__":
    main()
