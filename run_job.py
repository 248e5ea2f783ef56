"""spark-submit entry point for the batch jobs.

    zip -r hostlens.zip hostlens
    spark-submit --py-files hostlens.zip run_job.py calendar-etl <calendar.csv> <out_dir>

See :mod:`hostlens.jobs` for the job list.
"""

from hostlens.jobs import main

if __name__ == "__main__":
    main()
