"""Readers. Every file source takes an explicit schema; none infers one."""
