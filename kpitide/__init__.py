"""Recharge-order KPIs, stateful word counts and offset bookkeeping as Spark DataFrame jobs."""
