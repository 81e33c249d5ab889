"""File for ``spark-submit``: ``spark-submit --py-files kpitide.zip run_job.py kpi --files ... --out ...``."""

from kpitide.app import main

if __name__ == "__main__":
    main()
