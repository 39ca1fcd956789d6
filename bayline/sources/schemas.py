"""Explicit schemas, keys and relationships of the eight service tables."""

from __future__ import annotations

# fixed values: columns and types of the raw tables
SCHEMAS = {
    "customers": "customer_id DOUBLE, customer_since DATE, region STRING, customer_type STRING",
    "vehicles": "vehicle_id BIGINT, customer_id BIGINT, vehicle_model STRING, model_year INT, "
    "powertrain STRING, vehicle_age INT, warranty_status STRING",
    "dealers": "dealer_id BIGINT, region STRING, dealer_type STRING, service_bay_count INT, "
    "technician_count INT",
    "appointments": "appointment_id BIGINT, customer_id BIGINT, vehicle_id BIGINT, "
    "dealer_id BIGINT, booking_date TIMESTAMP_NTZ, appointment_date TIMESTAMP_NTZ, "
    "service_type STRING, scheduled_duration_hours DOUBLE, appointment_status STRING, "
    "promised_completion TIMESTAMP_NTZ",
    "service_visits": "visit_id BIGINT, appointment_id BIGINT, check_in_time TIMESTAMP_NTZ, "
    "service_start_time TIMESTAMP_NTZ, completion_time TIMESTAMP_NTZ, visit_status STRING, "
    "actual_duration_hours DOUBLE, promised_completion TIMESTAMP_NTZ, delay_hours DOUBLE, "
    "delay_flag INT, first_time_fix_flag INT, dealer_id BIGINT, service_type STRING, "
    "service_bay_count INT, technician_count INT",
    "repairs": "repair_id BIGINT, visit_id BIGINT, repair_category STRING, "
    "estimated_hours DOUBLE, actual_hours DOUBLE, repair_status STRING",
    "parts": "part_transaction_id BIGINT, repair_id BIGINT, part_id BIGINT, "
    "part_order_date TIMESTAMP_NTZ, part_received_date TIMESTAMP_NTZ, parts_delay_flag INT",
    "customer_surveys": "survey_id BIGINT, visit_id BIGINT, survey_date DATE, "
    "csat_score DOUBLE, complaint_flag INT",
}

PRIMARY_KEYS = {
    "customers": "customer_id",
    "vehicles": "vehicle_id",
    "dealers": "dealer_id",
    "appointments": "appointment_id",
    "service_visits": "visit_id",
    "repairs": "repair_id",
    "parts": "part_transaction_id",
    "customer_surveys": "survey_id",
}

# (child, foreign key, parent, primary key), parents before their own children
RELATIONSHIPS = (
    ("vehicles", "customer_id", "customers", "customer_id"),
    ("appointments", "customer_id", "customers", "customer_id"),
    ("appointments", "vehicle_id", "vehicles", "vehicle_id"),
    ("appointments", "dealer_id", "dealers", "dealer_id"),
    ("service_visits", "appointment_id", "appointments", "appointment_id"),
    ("repairs", "visit_id", "service_visits", "visit_id"),
    ("parts", "repair_id", "repairs", "repair_id"),
    ("customer_surveys", "visit_id", "service_visits", "visit_id"),
)
